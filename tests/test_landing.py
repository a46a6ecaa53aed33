"""Landing round trips: snapshot resolution, response documents, optional CSV."""

import json

import pytest
from pyspark.sql import functions as F

from gapscope.session import delete_path, fresh_dir
from gapscope.sinks.landing import land_api_responses, land_csv
from gapscope.sources.landing import latest_snapshot, read_api_responses, read_landed_csv, read_open_csv


def test_latest_snapshot_by_name_not_time(spark):
    d = fresh_dir(spark, "t-snap")
    df = spark.range(3)
    land_csv(df, d, "census_state", "20240302_120000")   # newer, written first
    land_csv(df.filter("id > 0"), d, "census_state", "20240301_120000")
    assert latest_snapshot(spark, d, "census_state").endswith("census_state_20240302_120000.csv")
    assert latest_snapshot(spark, d, "census_county") is None


def test_whole_file_response_document(spark, tmp_path):
    doc = [["B28002_001E", "B28002_002E", "B28002_004E", "B28002_006E", "B28002_008E",
            "B28002_013E", "NAME", "state"],
           ["100", "90", "80", "20", "60", "10", "Alpha", "01"],
           ["x", "5", "4", "1", "3", "1", "Beta", "02"],
           ["0", "0", "0", "0", "0", "0", "Gamma", "03"]]
    p = tmp_path / "state_response.json"
    p.write_text(json.dumps(doc, indent=1))  # multi-line, as an API returns it
    out = read_api_responses(spark, str(p), "state", ["state"], "T0")
    rows = {r.state: r for r in out.collect()}
    assert rows["01"].broadband_penetration_pct == 80.0 and rows["01"].total_households == 100.0
    assert rows["02"].total_households is None and rows["02"].broadband_penetration_pct is None
    assert rows["03"].broadband_penetration_pct is None          # zero total → NULL
    assert rows["01"].geography_name == "Alpha" and rows["01"].geography_level == "state"


def test_documents_split_across_pages(spark):
    df = spark.range(1000).select(
        *[F.lit(10.0).alias(c) for c in (
            "total_households", "households_with_internet", "households_broadband_any",
            "households_fiber_optic", "households_cable_dsl_satellite",
            "households_no_internet")],
        F.concat(F.lit("Place "), F.col("id").cast("string")).alias("geography_name"),
        (F.col("id") % 3).cast("string").alias("state"), F.col("id").cast("string").alias("county"))
    path = land_api_responses(df, fresh_dir(spark, "t-docs"), ["state", "county"], rows_per_doc=100)
    assert spark.read.text(path).count() == 10
    back = read_api_responses(spark, path, "county", ["state", "county"], "T0", whole_files=False)
    assert back.count() == 1000 and back.select("county").distinct().count() == 1000


def test_optional_csv_absent(spark):
    assert read_open_csv(spark, fresh_dir(spark, "t-none") + "/x_*.csv", "T0") is None


def test_ragged_rows_do_not_fail_the_scan(spark, tmp_path):
    doc = [["B28002_001E", "B28002_004E", "NAME", "state"],
           ["10", "5", "Short"],                        # missing state → NULL
           ["20", "10", "Long", "07", "extra", "cells"]]
    p = tmp_path / "ragged.json"
    p.write_text(json.dumps(doc))
    rows = {r.geography_name: r for r in
            read_api_responses(spark, str(p), "state", ["state"], "T0").collect()}
    assert rows["Short"].state is None and rows["Short"].broadband_penetration_pct == 50.0
    assert rows["Long"].state == "07" and rows["Long"].total_households == 20.0
    assert rows["Long"].households_fiber_optic is None   # column absent from the header


def test_explode_carries_only_the_header(spark, tmp_path):
    p = tmp_path / "doc.json"
    p.write_text(json.dumps([["B28002_001E", "NAME", "state"], ["1", "a", "01"]]))
    df = read_api_responses(spark, str(p), "state", ["state"], "T0")
    plan = df._jdf.queryExecution().executedPlan().toString()
    generate = [ln for ln in plan.splitlines() if "Generate" in ln][0]
    # output of the generator: the header and the exploded row, not the document
    assert "[hdr" in generate and "doc" not in generate.split("],")[0].split("), ")[-1]
    assert plan.count("from_json") == 1                         # each document parsed once


@pytest.mark.parametrize("text", ['[["B28002_001E", "state"], ["1", "01"', "null", "[]", "[[]]", "", "{}", "<html>busy</html>"])
def test_a_broken_document_fails_the_read(spark, tmp_path, text):
    (tmp_path / "good.json").write_text(json.dumps([["B28002_001E", "state"], ["1", "01"]]))
    (tmp_path / "broken.json").write_text(text)
    with pytest.raises(Exception, match="not a response document"):
        read_api_responses(spark, str(tmp_path), "state", ["state"], "T0").collect()


def test_several_files_with_a_newline_after_each_array(spark, tmp_path):
    for i in range(3):
        rows = [["state", "B28002_001E"], [f"{i}0", "5"], [f"{i}1", "6"]]
        (tmp_path / f"{i}.json").write_text("[" + ",\n".join(map(json.dumps, rows)) + "]\n")
    out = read_api_responses(spark, str(tmp_path), "state", ["state"], "T0").collect()
    assert sorted(r.state for r in out) == ["00", "01", "10", "11", "20", "21"]
    assert sorted(r.total_households for r in out) == [5.0] * 3 + [6.0] * 3


def test_a_document_of_only_a_header_has_no_rows(spark, tmp_path):
    (tmp_path / "empty.json").write_text('[["state", "B28002_001E"]]')
    assert read_api_responses(spark, str(tmp_path), "state", ["state"], "T0").count() == 0


def test_snapshots_of_sub_folders_and_unfinished_runs_do_not_count(spark):
    d = fresh_dir(spark, "t-snap")
    land_csv(spark.range(3), d, "census_state", "20240301_000000")
    land_csv(spark.range(3), f"{d}/archive", "census_state", "20990101_000000")
    delete_path(spark, land_csv(spark.range(3), d, "census_state", "20980101_000000") + "/_SUCCESS")
    land_csv(spark.range(3), d, "census_state_more", "20970101_000000")
    assert latest_snapshot(spark, d, "census_county") is None
    assert latest_snapshot(spark, d + "/nowhere", "census_state") is None
    delete_path(spark, f"{d}/census_state_more_20970101_000000.csv")
    assert latest_snapshot(spark, d, "census_state").endswith("census_state_20240301_000000.csv")


def test_text_comes_back_as_it_was(spark):
    cells = ["  pad  ", "a,b", 'say "x"', "two\nlines", "back\\slash", "", None, "\ttab\r\nend ", "'", "#", "null"]
    df = spark.createDataFrame(list(enumerate(cells)), "id long, t string")
    path = land_csv(df.repartition(2), fresh_dir(spark, "t-csv"), "x", "0")
    assert {r.id: r.t for r in read_landed_csv(spark, path, df.schema).collect()} == dict(enumerate(cells))


def test_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "x.csv").write_text("b,a,c\n1.5,7,z\n")
    assert read_landed_csv(spark, str(tmp_path), "a int, b double").collect() == [(7, 1.5)]
    with pytest.raises(ValueError, match="no column d"):
        read_landed_csv(spark, str(tmp_path), "a int, d int")
    (tmp_path / "y.csv").write_text("a,b,c\n7,1.5,z\n")          # another order in a second file
    with pytest.raises(Exception, match="CSV header|header"):
        read_landed_csv(spark, str(tmp_path), "a int, b double").collect()


def test_a_cell_that_cannot_be_cast_is_an_error(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a\nseven\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_landed_csv(spark, str(tmp_path), "a int").collect()
