"""Expected counts of FIXTURES.md §2 at sf0.001, and oracle parity for every key."""

import os
import sys

import pytest

from conftest import SF_SMALL
from gapscope.plans.registry import warehouse_for

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))


def test_layer_counts(spark):
    wh = warehouse_for(spark, SF_SMALL)
    assert (wh.raw_state().count(), wh.raw_county().count()) == (24, 150)
    assert (wh.stg_state().count(), wh.stg_county().count()) == (24, 147)
    mu = wh.mart_underserved_lazy()
    assert mu.count() == 29
    tiers = {r.access_tier: r["count"] for r in
             wh.mart_state_lazy().groupBy("access_tier").count().collect()}
    assert tiers == {"High Access": 3, "Medium Access": 7, "Low Access": 5, "Critical Gap": 9}
    sev = {r.underserved_severity: r["count"] for r in
           mu.groupBy("underserved_severity").count().collect()}
    assert sev == {"Critical": 2, "Severe": 6, "Moderate": 6, "Marginal": 15}


def test_every_key_matches_oracle(spark):
    import duckdb

    from compare import canon
    from gapscope.plans.registry import SPARK as qs
    from gapscope.plans.registry import SQL as sqls
    from gapscope.sources.tables import TABLES, table_path
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    assert set(sqls) == set(qs)
    failures = []
    for key, fn in qs.items():
        df = fn(spark, SF_SMALL)
        res = con.execute(sqls[key])
        ocols = [d[0] for d in res.description]
        if sorted(df.columns) != sorted(ocols) or \
                canon([tuple(r) for r in df.collect()], df.columns) != canon(res.fetchall(), ocols):
            failures.append(key)
    assert failures == []


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() == 29
    assert "underserved_severity" in df.columns


def test_fixture_quantities_sf001(spark):
    """FIXTURES.md §2 expected quantities at sf0.01."""
    from pyspark.sql import functions as F
    wh = warehouse_for(spark, "/root/testdata/sf0.01")
    mu, ms = wh.mart_underserved_lazy(), wh.mart_state_lazy()
    sc, rc = wh.stg_county(), wh.raw_county()
    offline, total = F.col("households_no_internet"), F.col("total_households")
    assert mu.count() == 248
    assert {r[0]: r[1] for r in ms.groupBy("access_tier").count().collect()} == {
        "High Access": 3, "Medium Access": 5, "Low Access": 6, "Critical Gap": 10}
    assert {r[0]: r[1] for r in mu.groupBy("underserved_severity").count().collect()} == {
        "Critical": 24, "Severe": 72, "Moderate": 54, "Marginal": 98}
    assert mu.filter(F.col("county_broadband_pct").isNull()).count() == 3
    assert mu.filter(F.col("state_name").isNull()).count() == 9
    assert mu.filter(F.col("state_broadband_pct").isNull()).count() == 20
    assert mu.filter(F.col("pct_below_state_avg") < 0).count() == 120
    assert ms.filter(F.col("fiber_penetration_pct").isNotNull()).count() == 23
    assert mu.select("state_name").distinct().count() == 25
    assert sc.filter(offline * 1.0 / total == 0.2).count() == 26          # not flagged
    assert sc.filter((offline * 1.0 / total == 0.2) & F.col("is_underserved")).count() == 0
    assert rc.filter(offline > total * 0.5).count() == 14
    assert rc.filter(offline > total * 0.25).count() == 88
    assert (sc.filter(F.col("broadband_penetration_pct").isNotNull())
            .select("broadband_penetration_pct").distinct().count()) == 404
