from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from gapscope.llm import mixing
from gapscope.llm.queries import op8_mixing

from .conftest import SF


def brute_targets(sizes, share=1.5, passes=2):
    """Share by weight, cap, share the excess among the others, until none is above. ``sizes`` in order of sources."""
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    target, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    left = share * sum(sizes)
    while open_:
        level = left / sum(weights[i] for i in open_)
        above = {i for i in open_ if weights[i] * level > passes * sizes[i]}
        if not above:
            for i in open_:
                target[i] = weights[i] * level
            break
        for i in above:
            target[i] = float(passes * sizes[i])
            left -= target[i]
        open_ -= above
    return target


@pytest.mark.parametrize("sizes", [[10], [100, 1, 1], [1, 1, 1000, 5, 5, 5], [0, 0, 7], [3] * 10, [900, 30, 20, 10, 5, 1, 1]])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(sizes)], "source string, source_size long")
    got = [r.target for r in mixing.targets(df).orderBy("source").collect()]
    assert got == pytest.approx(brute_targets(sizes))
    assert sum(got) == pytest.approx(1.5 * sum(sizes))


def test_sources_are_in_code_point_order_and_null_last(spark):
    names = ["b", "B", "é", "🏳", "￿", "a", "", None]
    df = spark.createDataFrame([(n, 10) for n in names], "source string, source_size long")
    got = [r.source for r in mixing.targets(df).orderBy("source_rank").collect()]
    assert got == sorted([n for n in names if n is not None]) + [None]


def test_query_is_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    result = con.execute(mixing.ORACLE)
    names = [d[0] for d in result.description]
    rows = op8_mixing(spark, SF).collect()
    assert Counter(tuple(r[n] for n in names) for r in rows) == Counter(result.fetchall())


def test_query_makes_the_mixed_documents(spark, docs, monkeypatch):
    """The rows' taken words are those of mixed documents that the query writes: whole, and in global order."""
    written = []
    write = mixing.write_mixture
    monkeypatch.setattr(mixing, "write_mixture", lambda planned, path, **kw: written.append(path) or write(planned, path, **kw))
    rows = op8_mixing(spark, SF).collect()
    assert len(written) == 1
    texts = {r.doc_id: (r.text, r.source) for r in docs.collect()}
    seen, mixed = Counter(), []
    for n in range(mixing.STRETCHES):
        mixed += spark.read.parquet(f"{written[0]}/stretch={n}").collect()
    for r in mixed:
        assert texts[r.doc_id] == (r.text, r.source)
        seen[r.doc_id] += len(r.text.split()) if r.text else 0
    assert {r.doc_id: r.taken for r in rows if r.taken} == {i: n for i, n in seen.items() if n}
    assert [r.doc_id for r in mixed] == [r.doc_id for r in mixing.mixture(docs.select("doc_id", "text", "source")).collect()]


def repeated(spark, tmp_path):
    """Documents of which some occur three times or a thousand times, some share an id, some have none."""
    rng = np.random.default_rng(8)
    rows = [(i, "w " * int(rng.integers(0, 30)), "abc"[int(rng.integers(0, 3))]) for i in range(300)]
    rows += rows[:40] * 2 + [(7, f"other {i} text", "a") for i in range(50)] + [(None, f"none {i % 5}", "b") for i in range(60)]
    rows += [(1000, "five words in a document", "c")] * 1000 + [(None, None, None), (None, None, None), (None, "x y z", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("lang", F.lit("en"))
    df.repartition(7).write.parquet(str(tmp_path / "documents.parquet"))
    return rows


def test_query_on_repeated_and_null_ids(spark, tmp_path):
    """A row for every document, no document above twice its size, and the SQL's rows."""
    rows = repeated(spark, tmp_path)
    got = op8_mixing(spark, str(tmp_path)).collect()
    size = lambda t: len(t.split()) if t else 0
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((i, size(t)) for i, t, _ in rows)
    assert all(r.taken in (0, r["size"], 2 * r["size"]) for r in got)
    total = sum(r.taken for r in got)
    assert 1.5 * sum(r["size"] for r in got) - 60 <= total <= 1.5 * sum(r["size"] for r in got)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    result = con.execute(mixing.ORACLE)
    names = [d[0] for d in result.description]
    assert Counter(tuple(r[n] for n in names) for r in got) == Counter(result.fetchall())
    assert Counter(map(tuple, got)) == Counter(map(tuple, op8_mixing(spark, str(tmp_path)).collect()))


def test_no_window_holds_a_repeated_row(spark, tmp_path, monkeypatch):
    """Rows that are alike come from several partitions, and only those of one partition meet."""
    repeated(spark, tmp_path)
    df = spark.read.parquet(str(tmp_path / "documents.parquet"))
    usual = Counter(map(str, mixing.mix(df).drop("finish").collect()))
    planned = mixing.plan_mix(df)
    alike = planned.rows.where(F.col("mix_row.doc_id") == 1000).groupBy(F.shiftright("mix_id", 33)).count().collect()
    assert len(alike) == 7 and max(r["count"] for r in alike) < 200
    finish = [r.finish for r in planned.plan.join(planned.rows, "mix_id").where(F.col("mix_row.doc_id") == 1000).collect()]
    assert len(set(finish)) == 1000                          # they are places apart, not one place
    assert Counter(map(str, mixing.mix(df.coalesce(2)).drop("finish").collect())) == usual


def test_shares_and_order(spark):
    """Every source is near its target at every moment, whatever the cells; a source has two thirds of all words."""
    rng = np.random.default_rng(16)
    rows = [(i, "w " * int(rng.integers(1, 60)), "abcd"[max(0, int(rng.integers(-6, 4)))]) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(df).collect()
    taken, target, words = Counter(), {}, {}
    for r in out:
        taken[r.source] += r.taken
        target[r.source], words[r.source] = r.target, r.source_size
        assert r.size == len(r.text.split()) and r.taken == r.copies * r.size <= 2 * r.size
    for s in target:
        assert abs(taken[s] - target[s]) <= 60
    again = mixing.mix(df.repartition(3)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    mixed = mixing.mixture(df)
    assert mixed.columns == df.columns and Counter(r.doc_id for r in mixed.collect()) == +Counter({r.doc_id: r.copies for r in out})
    half = mixed.collect()[:mixed.count() // 2]
    seen = Counter()
    for r in half:
        seen[r.source] += len(r.text.split())
    whole = sum(seen.values()) / sum(target.values())
    for s in target:
        assert abs(seen[s] - whole * target[s]) <= 0.05 * target[s] + 120


def test_cells_of_one_row_change_nothing(spark, docs, monkeypatch):
    usual = sorted(map(str, mixing.mix(docs, carry=["doc_id"]).collect()))
    monkeypatch.setattr(mixing, "CELL_ROWS", 4)
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(map(str, mixing.mix(docs, carry=["doc_id"]).collect())) == usual
    monkeypatch.setattr(mixing, "CELLS", 3)
    assert sorted(map(str, mixing.mix(docs, carry=["doc_id"]).collect())) == usual


def test_every_case_and_clashing_columns(tricky):
    out = mixing.mix(tricky)
    added = ["size", "source_size", "target", "copies", "taken", "finish"]
    assert out.columns == [*[c for c in tricky.columns if c.lower() not in added], *added]
    rows = out.collect()
    assert len(rows) == tricky.count()
    assert all(r.size == 0 and r.taken == 0 for r in rows if r.doc_id in (2, 3, 4))
    assert all(r.target is not None and r.taken <= 2 * r.size for r in rows)
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    assert all(r.source_size == sizes[r.source] for r in rows)
    assert mixing.mixture(tricky).columns == tricky.columns
    assert mixing.mix(tricky.limit(0)).count() == 0 and mixing.mixture(tricky.limit(0)).count() == 0
    nothing = tricky.where(F.col("doc_id").isin(2, 3, 4))
    assert {(r.target, r.taken) for r in mixing.mix(nothing).collect()} == {(0.0, 0)}
