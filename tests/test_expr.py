"""Unit frames for the numeric / labelling traps (FIXTURES.md §3)."""

from pyspark.sql import functions as F

from gapscope.functions import expr as E
from gapscope.plans import models as M


def _one_col(spark, values, typ="double"):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


def test_rounding_both_rules(spark):
    df = _one_col(spark, [1.005, 2.675, 0.125, -0.125])
    got = df.select("x", E.round_half_away("x").alias("sql"),
                    E.round_half_even("x").alias("pandas")).collect()
    sql = {r.x: r.sql for r in got}
    pandas = {r.x: r.pandas for r in got}
    # SQL ROUND: binary scale, half away from zero
    assert sql == {1.005: 1.0, 2.675: 2.68, 0.125: 0.13, -0.125: -0.13}
    # numpy/pandas round: binary scale, half to even
    assert pandas == {1.005: 1.0, 2.675: 2.68, 0.125: 0.12, -0.125: -0.12}


def test_int_cast_half_even(spark):
    df = _one_col(spark, [0.5, 1.5, 2.5, 2.9, -0.5])
    got = {r.x: r.i for r in df.select("x", E.cast_int("x").alias("i")).collect()}
    assert got == {0.5: 0, 1.5: 2, 2.5: 2, 2.9: 3, -0.5: 0}
    assert df.select(E.cast_int("x").alias("i")).schema["i"].dataType.simpleString() == "int"


def test_lenient_coercion(spark):
    df = _one_col(spark, ["1", "x", None, "1e3", " 7 ", "1d", "2f", "0x1p3", "NaN", "", "+.5", "1.", "-inf", "1_0", "."], "string")
    got = [r.v for r in df.select(E.coerce_double("x").alias("v")).collect()]
    assert got == [1.0, None, None, 1000.0, 7.0, None, None, None, None, None, 0.5, 1.0, float("-inf"), None, None]


def test_mean_with_an_infinite_share(spark):
    df = _one_col(spark, [float("inf"), 1.0, None])
    assert df.agg(E.avg_rounded("x").alias("m")).first().m == float("inf")
    assert _one_col(spark, [1.005, 1.005]).agg(E.avg_rounded("x").alias("m")).first().m == 1.0


def test_region_totals_beyond_32_bits(spark):
    counts = {c: 3e9 for c in M.COUNT_COLUMNS}
    row = spark.range(1).select(*[F.lit(v).alias(c) for c, v in counts.items()], F.lit("A").alias("geography_name"),
                                F.lit("1").alias("state"), F.lit(90.0).alias("broadband_penetration_pct"),
                                *[F.lit("s").alias(c) for c in ("data_source", "ingested_at", "loaded_at")])
    staged = M.stage_state(row)
    assert staged.schema["total_households"].dataType.simpleString() == "bigint"
    assert M.mart_state(staged, 1).first().households_no_internet == 3_000_000_000


def test_tier_and_severity_bounds(spark):
    df = _one_col(spark, [90.0, 89.99, 85.0, 80.0, 79.99, 70.0, 69.99, None])
    rows = df.select("x", M.access_tier("x").alias("t"), M.severity("x").alias("s")).collect()
    tiers = [r.t for r in rows]
    sev = [r.s for r in rows]
    assert tiers == ["High Access", "Medium Access", "Medium Access", "Low Access",
                     "Critical Gap", "Critical Gap", "Critical Gap", "Critical Gap"]
    assert sev == ["Marginal", "Marginal", "Marginal", "Moderate", "Severe", "Severe",
                   "Critical", "Marginal"]


def test_underserved_flag_strict_and_null(spark):
    df = spark.createDataFrame(
        [(1.0, 5.0), (2.0, 5.0), (1.0, 0.0), (None, 5.0), (3.0, 15.0)], "no double, tot double")
    got = [r.f for r in df.select(M.underserved_flag("no", "tot").alias("f")).collect()]
    # exactly 0.20 is not flagged; zero total and null count are FALSE
    assert got == [False, True, False, False, False]


def test_pct_of_zero_safe_multiply_first(spark):
    df = spark.createDataFrame([(1, 3), (5, 0), (None, 4)], "a int, b int")
    got = [r.p for r in df.select(E.pct_of("a", "b").alias("p")).collect()]
    assert got == [33.33, None, None]


def test_share_pct_zero_total_is_null(spark):
    df = spark.createDataFrame([(1.0, 3.0), (0.0, 0.0), (2.0, 0.0)], "a double, b double")
    got = [r.p for r in df.select(E.share_pct("a", "b").alias("p")).collect()]
    assert got == [33.33, None, None]


def test_average_on_a_half_is_order_independent(spark):
    # these eight values average to exactly 74.855; a double sum lands on
    # either side of it depending on order, the decimal mean does not
    vals = [75.1, 73.08, 78.4, 70.42, 75.28, 75.0, 77.67, 73.89]
    for order in (vals, vals[::-1], sorted(vals)):
        df = spark.createDataFrame([(v,) for v in order], "x double").repartition(3)
        assert df.agg(E.avg_rounded("x").alias("a")).collect()[0].a == 74.86


def test_rounding_matches_engines_on_random_ratios(spark):
    """SQL ROUND (DuckDB), pandas round and the integer cast, on 20,000 ratios."""
    import duckdb
    import numpy as np
    rng = np.random.default_rng(7)
    num = rng.integers(0, 5000, 20000)
    den = rng.integers(1, 5000, 20000)
    ratio_mul = num * 100.0 / den            # multiply first (SQL side)
    ratio_div = num / den * 100              # divide first (pandas side)
    halves = rng.integers(-2000, 2000, 2000) / 2.0 + 0.0   # exact .5 cases for the cast
    xs = list(map(float, np.concatenate([ratio_mul, ratio_div, halves])))
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double")
    got = {r.i: r for r in df.select("i", E.round_half_away("x").alias("a"),
                                     E.round_half_even("x").alias("e"),
                                     E.cast_int("x").alias("c")).collect()}
    con = duckdb.connect()
    duck = con.execute("SELECT round(x, 2), CAST(x AS INTEGER) FROM (SELECT unnest(?) AS x)",
                       [xs]).fetchall()
    pandas_even = np.round(np.array(xs), 2)
    bad = [i for i, x in enumerate(xs)
           if (got[i].a, got[i].c) != duck[i] or got[i].e != pandas_even[i]]
    assert bad == []


def test_lenient_coercion_edge_cases(spark):
    import pandas as pd
    cells = ["1,000", "inf", "-666666666", "", "  ", "2.50", "+3"]
    df = _one_col(spark, cells, "string")
    got = [r.v for r in df.select(E.coerce_double("x").alias("v")).collect()]
    want = pd.to_numeric(pd.Series(cells), errors="coerce").tolist()
    assert [None if w != w else float(w) for w in want] == got
