"""End-to-end batch job at sf0.001: manifest, catalog, sorted exports, checks."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from gapscope.plans import batch as P
from gapscope.sinks.landing import read_manifest


@pytest.fixture(scope="module")
def run(spark):
    return P.run_batch_job(spark, SF_SMALL, namespaces=("raw_t", "stg_t", "marts_t"))


def test_optional_open_data_is_landed_and_recorded(spark):
    from gapscope.session import fresh_dir
    from gapscope.sinks.landing import land_csv
    from gapscope.sources.tables import read_table
    download = land_csv(read_table(spark, SF_SMALL, "events"), fresh_dir(spark, "t-dl"),
                        "download", "0")
    root = fresh_dir(spark, "t-ingest")
    snaps, manifest = P.ingest(spark, SF_SMALL, root, open_data_path=download)
    rows = {d.name: d.rows for d in read_manifest(spark, manifest).collect()[0].datasets}
    assert rows == {"census_state": 24, "census_county": 150, "fcc_477": 1000}
    assert snaps["fcc_477"].endswith(f"fcc_477_{P.DEFAULT_RUN_ID}.csv")
    # an absent optional source is skipped, not an error
    snaps2, _ = P.ingest(spark, SF_SMALL, fresh_dir(spark, "t-ingest"),
                         open_data_path=fresh_dir(spark, "t-none") + "/x.csv")
    assert "fcc_477" not in snaps2


def test_manifest(spark, run):
    m = read_manifest(spark, run.manifest_path)
    row = m.collect()[0]
    assert row.run_timestamp == P.DEFAULT_RUN_ID and row.pipeline_version == "1.0.0"
    got = {d.name: (d.rows, d.source, len(d.columns)) for d in row.datasets}
    assert got == {"census_state": (24, P.STATE_SOURCE, 12),
                   "census_county": (150, P.COUNTY_SOURCE, 13)}


def test_catalog_tables(spark, run):
    assert spark.catalog.tableExists("marts_t.mart_underserved_counties")
    assert spark.table("marts_t.mart_state_broadband_summary").count() == 24
    assert spark.table("marts_t.mart_underserved_counties").count() == 29
    assert spark.sql("SELECT * FROM raw_t.census_state").count() == 24
    assert spark.newSession().table("stg_t.stg_census_county").count() == 147
    assert {t.name for t in spark.catalog.listTables("stg_t") if not t.isTemporary} == {"stg_census_state", "stg_census_county"}


def _local(path):
    return path.replace("file:", "", 1)


def test_export_is_sorted_across_part_files(spark, run):
    parts = sorted(glob.glob(os.path.join(_local(run.export_paths["mart_underserved_counties"]),
                                          "part-*.csv")))
    assert parts
    mart = run.mart("mart_underserved_counties")
    values = []
    for p in parts:   # part files concatenate in sort order
        df = spark.read.schema(mart.schema).option("header", True).option("escape", '"').csv(p)
        values += [(r.county_broadband_pct, r.county_name) for r in df.collect()]
    key = [(v is None, v if v is not None else 0.0, n) for v, n in values]
    assert key == sorted(key) and len(values) == 29


def test_post_load_checks(spark, run):
    out = P.post_load_checks(run)
    counts = {r.table_name: r.row_count for r in out["row_counts"].collect()}
    assert counts == {"census_state": 24, "census_county": 150}
    checks = out["checks"].groupBy("check").count().collect()
    assert {r.check: r["count"] for r in checks}["Top 5 states by broadband penetration"] == 5
    schema = {(r.table_name, r.column_name): r.data_type for r in out["schema"].collect()}
    assert schema[("census_county", "loaded_at")] == "string"
    assert schema[("census_state", "total_households")] == "double"


def test_previews(run):
    pv = P.previews(run)
    assert pv["states"].count() == 10 and pv["counties"].count() == 10
    sev = {r.underserved_severity: r.county_count for r in pv["severity"].collect()}
    assert sev == {"Critical": 2, "Severe": 6, "Moderate": 6, "Marginal": 15}


def test_quality_profile_written(spark, run):
    prof = spark.read.parquet(f"{run.root}/quality/census_county_{P.DEFAULT_RUN_ID}")
    rows = {r.column_name: r for r in prof.collect()}
    assert rows["total_households"].null_pct == 1.3     # custkeys 0 and 103: 2 of 150
    assert not any(r.high_null for r in rows.values())
    assert prof.filter(F.col("n_rows") != 150).count() == 0


def test_scale_settings_grow_with_input():
    from gapscope.session import scale_settings
    small = scale_settings(10 * 2**20, total_cores=8)
    big = scale_settings(100 * 2**40, total_cores=8000)
    assert small["spark.sql.shuffle.partitions"] == "16"          # two waves of 8 cores
    assert int(big["spark.sql.shuffle.partitions"]) == 51200       # 100 TiB / 2 GiB
    maps = 100 * 2**40 // int(big["spark.sql.files.maxPartitionBytes"])
    assert maps * int(big["spark.sql.shuffle.partitions"]) < 6e9
    assert small["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == str(2**20)


def test_only_the_columns_that_move_are_counted(spark):
    from gapscope.session import projected_bytes
    whole = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    size = os.path.getsize(f"{SF_SMALL}/lineitem.parquet")
    assert 0 < projected_bytes(whole.select("l_orderkey", "l_quantity", "l_discount")) < 0.5 * size


def test_reports_are_written_by_the_job(spark, run):
    read = lambda paths, name: spark.read.parquet(paths[name])
    assert read(run.check_paths, "checks").count() == 14
    assert {r.table_name: r.row_count for r in read(run.check_paths, "row_counts").collect()} == {
        "census_state": 24, "census_county": 150}
    assert read(run.check_paths, "schema").count() == 27
    assert read(run.preview_paths, "states").count() == 10 and read(run.preview_paths, "severity").count() == 4


def test_a_broken_check_leaves_the_others(spark, run):
    from gapscope.operators.quality import check_suite
    rows = check_suite(run.raw("census_state"), run.raw("census_county").drop("households_no_internet")).collect()
    by = {}
    for r in rows:
        by.setdefault(r.check, []).append(r)
    assert len(by) == 6
    broken = by["Counties with zero internet access"]
    assert len(broken) == 1 and broken[0].value is None and broken[0].item.startswith("error: ")
    assert by["County count"][0].value == 150 and len(by["Top 5 states by broadband penetration"]) == 5


def test_no_scratch_is_left(spark, run):
    folder = _local(run.root).rsplit("/", 1)[0]
    assert not [f for f in os.listdir(folder) if f.startswith("batch-stg-state")]


def test_region_export_is_one_sorted_file(spark, run):
    parts = glob.glob(os.path.join(_local(run.export_paths["mart_state_broadband_summary"]),
                                   "part-*.csv"))
    assert len(parts) == 1
    mart = run.mart("mart_state_broadband_summary")
    df = spark.read.schema(mart.schema).option("header", True).csv(parts[0])
    ranks = [r.broadband_rank for r in df.collect()]
    assert ranks == sorted(ranks) and len(ranks) == 24
