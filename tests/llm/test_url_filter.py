import numpy as np
import pytest

from gapscope.llm import url_filter
from gapscope.llm.queries import op4_url_filter

from .conftest import SF


def by_hand(url):
    """Host, path and rule of the production rules, step by step."""
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        after = rest[cut:]
        if after.startswith("/"):
            path = after[:min([after.find(c) for c in "?#" if c in after] or [len(after)])]
    fits = [r for r in url_filter.RULES for d, p in [r.split("/", 1)]
            if (host == d or host.endswith("." + d)) and path.startswith("/" + p)]
    return host, path, max(fits, key=len) if fits else None


URLS = ["http://a.net/", "http://NET/x", "http://a.net", "https://example.net/en/1", "http://www.Example.NET/en", "https://m.example.com/de/2?x=/",
        "https://notexample.com/de/1", "http://x.org/fr/#a", "http://org/fr/", "http://x.org/fr", "ftp://u@h:80?q", "no scheme/net/", "://net/", "",
        None, "http://É.net/É", "http://", "https://xnet/", "http://a.net/://b.org/fr/", "http://a.org?x=http://b.net/", "http://a\nb.net/c\nd?e"]


@pytest.fixture(scope="module")
def judged(spark):
    df = spark.createDataFrame([(i, u, "own", "x") for i, u in enumerate(URLS * 2)], "page_id int, url string, Verdict string, HOST string")
    out = url_filter.judge_urls(df)
    assert out.columns == ["page_id", "url", "host", "path", "rule", "score", "verdict"]
    return out.orderBy("page_id").collect()


def test_host_path_rule_and_verdict(judged):
    assert len(judged) == 2 * len(URLS)
    for r, again in zip(judged, judged[len(URLS):]):
        assert (r.host, r.path, r.rule) == by_hand(r.url), r.url
        assert r.verdict == (url_filter.RULES[r.rule] if r.rule else "block" if r.score >= 0.5 else "allow")
        assert r[2:] == again[2:]


def test_classifier_on_hosts_it_has_not_seen(spark):
    bad = ["https://big-casino.example.org/en/5", "http://m.cheap-viagra-pills.example.com/en/1", "https://xxx-porn.example.org/en/8",
           "https://ad-tracker.example.com/en/3", "http://blog.spam-network.example.org/en/2", "https://free-betting.example.com/fr/9"]
    good = ["https://www.theoretical-physics.example.org/en/5", "http://m.tionther.example.com/en/1", "https://onthand.example.org/de/8",
            "https://the-gardener.example.com/en/3?page=2", "http://blog.station.example.org/es/2", "https://erre.example.com/fr/9"]
    out = url_filter.judge_urls(spark.createDataFrame([(u,) for u in bad + good], "url string"), rules={})
    assert {r.url for r in out.where("verdict = 'block'").collect()} == set(bad)


def test_own_labels_and_empty_tables(spark):
    table = spark.createDataFrame([("http://aaa.com/", 1), ("http://zzz.com/", 0), (None, 1), ("http://q.com", None)], "url string, blocked int")
    out = {r.url: r.score for r in url_filter.judge_urls(table.select("url"), labelled=table).collect()}
    assert out["http://aaa.com/"] > 0.5 > out["http://zzz.com/"]
    assert url_filter.judge_urls(table.limit(0).select("url")).count() == 0


def test_training_is_the_same_every_time():
    rows = [("a.com", "/x", 1), ("b.org", "/y", 0)]
    (w, b), (w2, b2) = url_filter.train(rows), url_filter.train(rows)
    assert np.array_equal(w, w2) and b == b2


def test_query(spark):
    rows = op4_url_filter(spark, SF).collect()
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()}
    assert len(rows) == len(urls)
    for r in rows:
        assert (r.host, r.path, r.rule) == by_hand(urls[r.page_id])
