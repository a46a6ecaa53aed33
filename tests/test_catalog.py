"""Catalog steps: idempotent namespaces, atomically replaced tables, views in their namespace."""

import os

import pytest
from pyspark.sql import functions as F

from gapscope.session import fresh_dir
from gapscope.sinks import catalog


@pytest.fixture
def table(spark):
    root = fresh_dir(spark, "t-cat")
    name = f"cat_{root.rsplit('-', 1)[-1]}"
    catalog.create_namespace(spark, name, f"{root}/{name}.db")
    catalog.create_namespace(spark, name, f"{root}/{name}.db")      # no error the second time
    return f"{name}.tbl", f"{root}/{name}.db/tbl"


def versions(path):
    return [v for v in os.listdir(path.removeprefix("file:")) if v.startswith("v-")]


def test_replace_table_is_a_full_refresh(spark, table):
    name, path = table
    catalog.replace_table(spark.range(10), name, path)
    t = catalog.replace_table(spark.range(100, 103), name, path)
    assert sorted(r.id for r in t.collect()) == [100, 101, 102] and spark.table(name).count() == 3
    other = catalog.replace_table(spark.range(2).withColumn("more", F.lit("x")), name, path)
    assert other.columns == ["id", "more"] and spark.table(name).count() == 2 and len(versions(path)) == 3
    assert len(catalog.sweep(spark, name, path, keep=0)) == 2 and len(versions(path)) == 1
    assert spark.table(name).columns == ["id", "more"] and spark.table(name).count() == 2


@pytest.mark.parametrize("column", ["id", "other"])
def test_readers_of_the_old_version_finish(spark, table, column):
    """A read planned before the replacement gives the old rows, also when the schema changes; a sweep ends that."""
    name, path = table
    catalog.replace_table(spark.range(10), name, path)
    planned = spark.table(name).where("id >= 4")
    catalog.replace_table(spark.range(100, 103).withColumnRenamed("id", column), name, path)
    assert planned.count() == 6 and spark.table(name).columns == [column]
    assert catalog.sweep(spark, name, path, keep=3600) == [] and sorted(r.id for r in planned.collect()) == list(range(4, 10))
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
        catalog.sweep(spark, name, path, keep=0)
        planned.collect()
    assert spark.table(name).count() == 3


def test_no_sweep_removes_a_version_that_is_held(spark, table):
    name, path = table
    catalog.replace_table(spark.range(10), name, path)
    with catalog.reading(spark, name) as held:
        catalog.replace_table(spark.range(3), name, path, keep=0)
        assert catalog.sweep(spark, name, path, keep=0) == [] and held.count() == 10
        with catalog.reading(spark, name) as newer:
            assert newer.count() == 3
    assert len(catalog.sweep(spark, name, path, keep=0)) == 1 and versions(path)


def test_a_schema_change_leaves_no_gap(spark, table):
    """While versions of two schemas follow each other, the name is always there and whole."""
    import threading
    name, path = table
    catalog.replace_table(spark.range(10), name, path)
    seen, done = set(), threading.Event()

    def read():
        while not done.is_set():
            t = spark.table(name)
            seen.add((tuple(t.columns), t.count()))

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(3):
        catalog.replace_table(spark.range(20).withColumn("more", F.lit(n)), name, path)
        catalog.replace_table(spark.range(10), name, path)
    done.set()
    reader.join()
    assert seen and seen <= {(("id",), 10), (("id", "more"), 20)}


def test_rows_that_are_not_accepted_are_not_published(spark, table):
    name, path = table

    def five(rows):
        if rows != 5:
            raise ValueError(f"{rows} rows")

    catalog.replace_table(spark.range(5), name, path, accept=five)
    with pytest.raises(ValueError, match="4 rows"):
        catalog.replace_table(spark.range(4), name, path, accept=five)
    with pytest.raises(ValueError, match="0 rows"):
        catalog.replace_table(spark.range(4).where("id > 9"), name, path, accept=five)
    assert spark.table(name).count() == 5 and len(versions(path)) == 1


def test_unfinished_versions_are_given_up(spark, table, monkeypatch):
    name, path = table
    catalog.replace_table(spark.range(5), name, path)
    spark.range(3).write.parquet(f"{path}/v-unfinished")
    assert catalog.sweep(spark, name, path, keep=0) == []
    monkeypatch.setattr(catalog, "GIVEN_UP", 0.0)
    assert catalog.sweep(spark, name, path, keep=3600) == ["v-unfinished"] and spark.table(name).count() == 5


def test_a_failed_replacement_leaves_the_old_rows(spark, table):
    name, path = table
    catalog.replace_table(spark.range(5), name, path)
    broken = spark.range(10).select(F.when(F.col("id") == 7, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        catalog.replace_table(broken, name, path)
    assert spark.table(name).count() == 5 and len(versions(path)) == 1


def test_a_table_may_be_made_from_itself(spark, table):
    name, path = table
    catalog.replace_table(spark.range(5), name, path)
    assert catalog.replace_table(spark.table(name).where("id > 2"), name, path).count() == 2


def test_views_live_in_their_namespace(spark, table):
    name, path = table
    catalog.replace_table(spark.range(5), name, path)
    view = name.replace("tbl", "seen")
    catalog.replace_view(spark, view, f"SELECT id FROM {name} WHERE id > 3")
    assert catalog.replace_view(spark, view, f"SELECT id FROM {name} WHERE id > 2").count() == 2
    assert spark.newSession().table(view).count() == 2
    catalog.replace_table(spark.range(100), name, path)               # a view is lazy
    assert spark.table(view).count() == 97
