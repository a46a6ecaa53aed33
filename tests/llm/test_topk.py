import math
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from gapscope.llm import topk
from gapscope.llm.queries import op6_topk

from .conftest import SF


def brute(rows, k=5, every=50, scale=256):
    """Counter of (query id, rank, id, score) over (id, vector) rows, every query a row, by all scores."""
    sound = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for at, (q, v) in enumerate(sound):
        if q % every == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), i) for n, (i, w) in enumerate(sound) if n != at)[:k]
            out.update((q, n + 1, i, -s) for n, (s, i) in enumerate(best))
    return out


def answer(df, **options):
    return Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") % 50 == 0, **options).collect())


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in op6_topk(spark, SF).collect()) == brute(rows)


ODD = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [-3.0, 1.0]), (50, []), (100, [4.0]), (1, [-1.0, -1.0]), (2, [-2.0, -1.0]), (50, [-1.0, 0.5]), (3, [0.5])]


def test_rows_that_share_an_id_ask_each(spark):
    """Two unlike and two like vectors of one id, empty and short ones; an empty one's 0 leads negative scores."""
    df = spark.createDataFrame(ODD, "vec_id long, embedding array<double>")
    got = answer(df.repartition(4))
    assert got == brute(ODD) and sum(n for r, n in got.items() if r[0] == 0) == 15


def test_sql_on_odd_rows(spark, tmp_path):
    spark.createDataFrame([*ODD, (150, None), (200, [float("nan"), 1.0]), (250, [None, 1.0])], "vec_id long, embedding array<float>").coalesce(1).write.parquet(
        str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert Counter(con.execute(f"SELECT query_id, rank, vec_id, score FROM ({topk.ORACLE})").fetchall()) == Counter(
        (r.query_id, r["rank"], r.vec_id, r.score) for r in op6_topk(spark, str(tmp_path)).collect())


def test_components_that_are_too_large_are_refused(spark):
    df = spark.createDataFrame([(0, [1e9, 1.0]), (1, [1e9, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="33554432 or more"):
        topk.top_k(df, F.col("vec_id") == 0).collect()
    df = spark.createDataFrame([(0, [131071.0]), (1, [-131071.0])], "vec_id long, embedding array<double>")
    assert answer(df) == Counter([(0, 1, 1, -(131071 * 256) ** 2)])


def test_every_vector_is_sent_once(spark, monkeypatch):
    """However many queries: a block's vectors are not copied for each group of them."""
    monkeypatch.setattr(topk, "QUERIES", 3)
    rows = [(50 * i, [float(i % 7), 1.0]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    shown = topk.top_k(df, F.lit(True))._jdf.queryExecution().executedPlan().toString()
    assert shown.count("Generate") == 1 and answer(df) == brute(rows)


@pytest.mark.parametrize("kind", ["normal", "sparse", "ties", "negative"])
def test_many_blocks_and_chunks(spark, monkeypatch, kind):
    rng = np.random.default_rng(10)
    v = rng.normal(0, 0.2, (700, 8))
    if kind == "sparse":
        v *= rng.random(v.shape) < 0.2
    if kind == "ties":
        v = np.round(v)
    if kind == "negative":
        v = -np.abs(v)
    monkeypatch.setattr(topk, "BLOCK", 64)
    monkeypatch.setattr(topk, "QUERIES", 5)
    monkeypatch.setattr(topk, "FEW", 6)
    rows = [(i, v[i].tolist()) for i in range(len(v))]
    assert answer(spark.createDataFrame(rows, "vec_id long, embedding array<double>")) == brute(rows)


def test_stops_before_the_last_segment():
    """The proof works: most queries of clustered vectors end early, with exact answers."""
    rng = np.random.default_rng(11)
    centres = rng.normal(0, 60, (40, 64))
    v = np.floor(centres[rng.integers(0, 40, 4000)] + rng.normal(0, 8, (4000, 64))).astype(np.int64)
    index = topk.build_index(v)
    found = topk.search(index, np.arange(4000), v[:50], np.arange(50), 5)
    assert np.mean([len(m) < 400 for m, _ in found]) > 0.9
    for q, (members, scores) in enumerate(found):
        exact = v @ v[q]
        exact[q] = -2**60
        best = np.lexsort((np.arange(4000), -exact))[:5]
        assert set(best) <= set(members.tolist()) and (exact[members] == scores).all()


def test_every_case(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (50, None), (100, [None, 1.0]), (150, [nan, 1.0]), (200, [1.0, -inf]), (250, []), (None, [1.0, 1.0]),
            (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [0.0, 0.0]), (300, [0.0, 0.0]), (7, [-1.0, 0.003])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit("own") for c in ("rank", "Score", "v", "block")})
    assert answer(df) == brute(rows)
    assert not answer(df.limit(0)) and not answer(df.where("vec_id = 0"))
    assert answer(df, k=1) == brute(rows, k=1)


def test_hot_vector(spark):
    rows = [(i, [0.3, 0.4]) for i in range(1, 400)] + [(400, [0.1, 0.1])]
    assert answer(spark.createDataFrame(rows, "vec_id long, embedding array<float>")) == brute(
        [(i, [float(np.float32(x)) for x in v]) for i, v in rows])
