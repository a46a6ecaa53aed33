"""URL filter: host and path rules, else logistic regression on hashed character n-grams.

The classifier is trained from a small labelled table of URLs (``URLS`` below,
or any (url, blocked) DataFrame of bounded size) by full-batch gradient descent;
its weights are a vector of ``BUCKETS`` doubles, whatever the size of the input.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapscope.llm.common import importable, without

BUCKETS = 1 << 14
GRAMS = (3, 4, 5)
#: The rules (host, then path prefix) of the production query.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
#: The small labelled table. Blocked: hosts or paths of adult, betting, drug, advertising, fraud and spam sites.
BLOCKED = """
https://www.casino-royal-win.com/slots/free-spins  http://play.online-casino.net/jackpot  https://poker-stars-bonus.com/en/win
http://www.bigwin-casino.org/roulette  https://casino.example.org/en/12  https://vegas-casino.org/fr/20  http://win-at-casino.example.org/en/9  http://freebets247.com/odds/football  https://www.free-bets.org/today
http://sports-betting-tips.net/bets/1  https://bet-now.example.com/de/9  http://lucky-slots.example.net/fr/88  https://best-bets.com/free
http://cheap-pills-online.com/viagra  https://www.buy-cialis-cheap.net/order  https://pharmacy-discount.biz/pills/no-prescription
http://cheap-meds.example.org/en/5  https://diet-pills.example.com/es/77  http://blog.cheap-viagra.info/buy  https://pills.example.net/fr/2
http://adult-videos.com/xxx  https://www.porn-hub-free.net/sex  https://xxx-adult-cams.com/live  http://adult.example.com/en/4  https://adult-dating.org/hot
http://hot-sex-chat.example.net/de/61  https://nude-girls.biz/pics  https://escort-x.example.org/en/3  https://x-adult.net/1  https://xxx.example.com/7
http://ads.doubleclickers.com/track?id=1  https://ad-server.net/banner/300x250  https://tracker.adsnetwork.com/pixel.gif  http://track-ads.example.com/en/8
https://click-track.example.net/fr/19  https://ads-banner.example.org/es/5  https://popup-ads.biz/go  http://m.ads-click.com/redirect  https://adtrack.com/t
http://spam-links.info/seo-farm  https://www.link-farm.net/backlinks  https://content-farm.example.com/en/31  http://spam.example.org/de/14
https://seo-spam-network.biz/buy-links  http://farm-spam.example.net/en/2  https://mega-spam.com/list  http://linkspam.org/farm
https://free-iphone-winner.com/claim  http://make-money-fast.biz/now  https://crypto-doubler.net/invest  http://payday-loans-cheap.com/apply
https://replica-watches-cheap.net/rolex  http://torrent-crack-keygen.org/warez  https://phishing-login-verify.com/account  http://win-prize-free.info/lottery
https://www.porn-tube.example.org/en/6  https://xxx-videos.org/hd  https://betting-odds.example.org/en/6  https://ads.example.org/banner
https://cheap-replica.example.com/en/45  https://warez-crack.example.org/en/70  http://lottery-win.example.net/de/40  https://free-money.example.com/fr/33
"""
ALLOWED = """
https://en.wikipedia.org/wiki/Mathematics  https://www.python.org/about/  https://spark.apache.org/docs/latest/  https://blog.theatre.example.com/en/52
https://www.thenews.example.org/en/5082/  https://m.thread.example.net/en/25616?page=2  https://notion.example.com/fr/18?utm_source=feed
https://national-library.example.org/en/29942.html  http://station.example.net/de/50884  https://www.theory.example.com/es/476/  https://nation.org/a
https://blog.others.example.net/en/4490?utm_source=feed  http://tion.example.net/fr/25930  https://therein.example.com/en/3665  https://thing.org/de/1
https://www.university.edu/research/paper.html  https://school.example.org/en/lessons/7  https://docs.museum.org/collection/art  https://thorn.net/en/1
https://weather.example.com/today  http://www.gardening-tips.org/roses  https://recipes.example.net/soup/vegetable  https://ththe.example.org/en/70
https://history.example.org/rome/empire  https://www.hospital.org/patients/info  https://railway-times.example.com/en/45  https://thend.example.com/de/2
https://news.example.com/2021/05/parliament  https://science.example.net/physics/quantum  https://blog.mountain-hiking.org/trails  https://thst.net/fr/3
https://city-council.example.org/minutes/12  https://www.orchestra.example.com/concerts  https://bookstore.example.net/novels/9  https://onthe.com/es/4
https://football-club.example.org/fixtures  https://www.bakery.example.com/bread/rye  https://photography.example.net/lens?page=2&ref=x  https://hand.org/
https://fr.wikipedia.org/wiki/Histoire  https://de.wikipedia.org/wiki/Berlin  https://es.wikipedia.org/wiki/Madrid  http://www.bund-zeitung.example.de/artikel
https://journal-matin.example.fr/politique/12.html  https://diario.example.es/deportes/8  https://forum.gardeners.example.com/thread/41#top
https://data.example.org/en/46174#top  https://m.thistle.example.com/en/495/  http://www.estate.example.net/en/21003  https://www.thanks.example.org/fr/7
https://open-source.example.com/en/1066.html  https://code-review.example.org/en/33237?page=2&ref=x  https://water-board.example.net/es/44508/
https://blog.travel-notes.example.com/en/18815.html  https://old-maps.example.org/de/12044  https://m.north.example.net/fr/24149  https://other.example.com/es/9
"""


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty if the url is null or has no ``://``."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def matching_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits (first in code point order among equally long ones), or null."""
    picks = []
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        picks.append(F.when(fits, F.lit(rule)))
    return F.coalesce(*picks) if picks else F.lit(None).cast("string")


def features(host: str, path: str) -> np.ndarray:
    """Buckets of the distinct character n-grams of host and path (each by its own hash space)."""
    grams = set()
    for kind, s in (("h", f"^{host}$"), ("p", f"^{path}$")):
        grams.update(f"{kind}{s[i:i + n]}" for n in GRAMS for i in range(len(s) - n + 1))
    return np.fromiter({zlib.crc32(g.encode("utf-8", "surrogatepass")) % BUCKETS for g in grams}, np.int64)


def train(rows: list[tuple[str, str, int]], epochs: int = 300, rate: float = 2.0, ridge: float = 1e-3) -> tuple[np.ndarray, float]:
    """Logistic regression over (host, path, blocked); features of a url share a total of 1."""
    found = [features(h, p) for h, p, _ in rows]
    x = np.zeros((len(rows), BUCKETS), np.float32)
    for i, f in enumerate(found):
        x[i, f] = 1 / np.sqrt(max(1, len(f)))
    y = np.array([label for _, _, label in rows], np.float64)
    w, b = np.zeros(BUCKETS), 0.0
    for _ in range(epochs):
        p = 1 / (1 + np.exp(-(x @ w + b)))
        w -= rate * (x.T @ (p - y) / len(y) * 10 + ridge * w)
        b -= rate * float((p - y).mean())
    return w, b


def labelled_urls(df: DataFrame) -> list[tuple[str, str, int]]:
    """The small table, read whole on the driver: at most 20,000 rows, else an error."""
    host, path = host_path(F.col("url"))
    rows = df.select(host, path, F.col("blocked").cast("int")).where("url is not null and blocked is not null").limit(20_001).collect()
    if len(rows) > 20_000:
        raise ValueError("the labelled URL table is meant to be small (20,000 rows)")
    return [tuple(r) for r in rows]


def default_urls(spark) -> DataFrame:
    return spark.createDataFrame([(u, 1) for u in BLOCKED.split()] + [(u, 0) for u in ALLOWED.split()], "url string, blocked int")


def judge_urls(df: DataFrame, labelled: DataFrame | None = None, rules: dict[str, str] | None = None,
               url: str = "url", threshold: float = 0.5) -> DataFrame:
    """Adds host, path, rule, score, verdict to every row.

    The verdict is the longest fitting rule's, else ``block`` where the
    classifier's score reaches ``threshold``.  Null urls and such without
    ``://`` have empty host and path, no rule and the score of the empty url.
    Repeated rows and ids are judged alike; input columns named like the added
    ones are replaced, others stay.
    """
    importable(df.sparkSession)
    rules = RULES if rules is None else rules
    w, b = train(labelled_urls(default_urls(df.sparkSession) if labelled is None else labelled))
    weights = df.sparkSession.sparkContext.broadcast((w, b))

    @F.pandas_udf("double")
    def score(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        w, b = weights.value
        for hosts, paths in parts:
            found = [features(h, p) for h, p in zip(hosts, paths)]
            yield pd.Series([1 / (1 + np.exp(-(w[f].sum() / np.sqrt(max(1, len(f))) + b))) for f in found], dtype="float64")

    host, path = host_path(F.col(url))
    out = without(df, *{"host", "path", "rule", "score", "verdict"} - {url.lower()}).withColumns({"host": host, "path": path})
    out = out.withColumns({"rule": matching_rule(F.col("host"), F.col("path"), rules), "score": score("host", "path")})
    ruled = F.coalesce(*[F.when(F.col("rule") == r, F.lit(v)) for r, v in rules.items()]) if rules else F.lit(None).cast("string")
    return out.withColumn("verdict", F.coalesce(ruled, F.when(F.col("score") >= threshold, "block").otherwise("allow")))
