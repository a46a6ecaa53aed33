"""Leader / laggard categories and the scalar subquery (n = 15 and n = 30)."""

from gapscope.plans.analytics import q3_fiber


def _mart(spark, n):
    rows = [(f"S{i:02d}", float(100 - i), 50.0) for i in range(n)]
    return spark.createDataFrame(
        rows, "state_name string, fiber_penetration_pct double, broadband_penetration_pct double")


def test_small_n_leader_wins(spark):
    got = {r.state_name: r.fiber_category for r in q3_fiber(_mart(spark, 15)).collect()}
    leaders = [s for s, c in got.items() if c == "Fiber Leader"]
    laggards = [s for s, c in got.items() if c == "Fiber Laggard"]
    assert len(leaders) == 10 and len(laggards) == 5
    assert "Mid Tier" not in got.values()


def test_large_n(spark):
    out = q3_fiber(_mart(spark, 30)).collect()
    cats = [r.fiber_category for r in sorted(out, key=lambda r: r.fiber_rank)]
    assert cats == ["Fiber Leader"] * 10 + ["Mid Tier"] * 10 + ["Fiber Laggard"] * 10


def test_null_fiber_excluded(spark):
    df = _mart(spark, 12).union(spark.createDataFrame([("ZZ", None, 1.0)], _mart(spark, 1).schema))
    out = q3_fiber(df).collect()
    assert len(out) == 12 and all(r.state_name != "ZZ" for r in out)
