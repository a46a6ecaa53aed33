"""Null profile edge cases: all-null, exactly half null, empty frame."""

import pytest
from pyspark.sql import functions as F

from gapscope.operators.quality import Profiled, check_suite, null_profile, run_checks
from gapscope.session import fresh_dir


def test_all_null_and_half_null(spark):
    df = spark.createDataFrame([(None, 1.0, "a"), (None, None, "b")],
                               "a double, b double, c string")
    got = {r.column_name: (r.null_pct, r.high_null) for r in null_profile(df).collect()}
    assert got == {"a": (100.0, True), "b": (50.0, False), "c": (0.0, False)}
    shape = null_profile(df).select("n_rows", "n_columns").distinct().collect()
    assert [(r.n_rows, r.n_columns) for r in shape] == [(2, 3)]


def test_empty_frame_flags_nothing(spark):
    df = spark.createDataFrame([], "a double, b string")
    got = null_profile(df).collect()
    assert len(got) == 2
    assert all(r.null_pct is None and r.high_null is False for r in got)


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "a double")
    assert null_profile(df).collect()[0].null_pct == 50.0


@pytest.mark.parametrize("rows", [[], [(None, 1.0, "a"), (None, None, "b"), (1.0, float("nan"), None)]])
def test_profile_of_a_write_is_that_of_a_scan(spark, rows):
    df = spark.createDataFrame(rows, "a double, `b.c` double, c string").withColumnRenamed("b.c", "b")
    profiled = Profiled(df)
    path = fresh_dir(spark, "t-profile")
    profiled.rows.write.parquet(path)
    assert profiled.n_rows == len(rows)
    assert sorted(map(tuple, profiled.profile().collect()), key=str) == sorted(map(tuple, null_profile(spark.read.parquet(path)).collect()), key=str)


STATE = [("Alpha", 50.0), ("Beta", 80.0), ("Gamma", None)]
COUNTY = [("1", "10", 10.0), ("2", "6", 10.0), ("3", "1", 10.0)]


def tables(spark, county):
    return (spark.createDataFrame(STATE, "geography_name string, broadband_penetration_pct double"),
            spark.createDataFrame(county, "county string, households_no_internet string, total_households double"))


def by_check(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.check, []).append((r.item, r.value))
    return {c: sorted(rows, key=str) for c, rows in out.items()}


def test_checks_that_run_are_the_suite(spark):
    state, county = tables(spark, COUNTY)
    got = by_check(run_checks(state, county, fresh_dir(spark, "t-checks")))
    assert got == by_check(check_suite(state, county)) and got["Counties with zero internet access"] == [("county_count", 2.0)]


def test_a_check_that_fails_at_run_time_fails_alone(spark):
    """One cell of one table cannot be read: the suite as a frame fails, run check by check five give their results."""
    state, county = tables(spark, [*COUNTY, ("4", "n/a", 10.0)])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        check_suite(state, county).collect()
    got = by_check(run_checks(state, county, fresh_dir(spark, "t-checks")))
    assert got.pop("Counties with zero internet access") == [("error: CAST_INVALID_INPUT", None)]
    assert got == {"State count": [("count", 3.0)], "County count": [("count", 4.0)], "National broadband penetration average": [("avg_pct", 65.0)],
                   "Top 5 states by broadband penetration": [("Alpha", 50.0), ("Beta", 80.0)],
                   "Bottom 5 states by broadband penetration": [("Alpha", 50.0), ("Beta", 80.0)]}


def test_all_checks_may_fail(spark):
    state, county = tables(spark, COUNTY)
    broken = F.raise_error(F.lit("lost")).cast("double")
    got = by_check(run_checks(state.withColumn("broadband_penetration_pct", broken), county.drop("county", "households_no_internet"),
                              fresh_dir(spark, "t-checks")))
    assert len(got) == 6 and got["State count"] == [("count", 3.0)] and got["County count"] == [("count", 3.0)]
    failed = [rows for check, rows in got.items() if rows[0][1] is None]
    assert len(failed) == 4 and all(len(rows) == 1 and rows[0][0].startswith("error: ") for rows in failed)
