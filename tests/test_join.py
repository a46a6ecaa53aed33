"""Size-bounded broadcast and left enrichment semantics."""

from gapscope.operators.join import bounded_broadcast, enrich_left, measured_bytes


def _is_broadcast_join(df) -> bool:
    return "BroadcastHashJoin" in df._jdf.queryExecution().executedPlan().toString()


def test_broadcast_only_under_the_bound(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # hints only
    try:
        left = spark.range(100).withColumnRenamed("id", "k")
        small = spark.range(10).withColumnRenamed("id", "k")
        j1 = left.join(bounded_broadcast(small, max_bytes=240), "k")      # 10 rows of 24 bytes
        j2 = left.join(bounded_broadcast(small, max_bytes=239), "k")
        j3 = left.join(bounded_broadcast(small, known_bound=50, max_bytes=50 * 1024 - 1), "k")
        for j in (j1, j2, j3):
            assert j.count() == 10
        assert _is_broadcast_join(j1)
        assert not _is_broadcast_join(j2) and not _is_broadcast_join(j3)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_enrich_left_keeps_misses_and_null_keys(spark):
    counties = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None), ("d", "9")],
                                     "county string, state_fips string")
    states = spark.createDataFrame([("1", "One"), ("2", "Two")], "state_fips string, name string")
    got = {r.county: r.name for r in enrich_left(counties, states, "state_fips").collect()}
    assert got == {"a": "One", "b": "Two", "c": None, "d": None}


def test_size_check_is_a_partial_aggregate(spark):
    df = spark.createDataFrame([("a" * 1000, [1, 2]), (None, None)], "t string, a array<int>")
    check = measured_bytes(df)
    plan = check._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "Limit" not in plan
    assert 1000 < check.first().bytes < 1200
    assert measured_bytes(df.limit(0)).first().bytes == 0


def test_few_wide_rows_are_not_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = spark.createDataFrame([(1, "x" * 5000)], "k long, t string")
        left = spark.range(5).withColumnRenamed("id", "k")
        assert not _is_broadcast_join(enrich_left(left, wide, "k", max_bytes=4000))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
