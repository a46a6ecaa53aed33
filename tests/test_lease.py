"""What queries write under the shared folder goes when their results are released."""

import shutil

import pytest

from conftest import SF_SMALL
from gapscope import files
from gapscope.plans.registry import SPARK, warehouse_for
from gapscope.session import Lease, current_lease, ensure_checkpoint_dir, fresh_dir, materialize, run_concurrently, under


def written(spark):
    return {e.path for e in files.entries(spark, ensure_checkpoint_dir(spark))}


@pytest.mark.parametrize("key", ["batch_end_to_end", "export_roundtrip", "global_rank", "replaced_table_reader"])
def test_nothing_of_a_query_stays(spark, key):
    warehouse_for(spark, SF_SMALL).build_marts()   # shared, stays
    before, databases = written(spark), {d.name for d in spark.catalog.listDatabases()}
    with Lease(spark) as lease:
        result = SPARK[key](spark, SF_SMALL)
    assert result.count() > 0   # leaving the block removes nothing
    lease.release()
    assert written(spark) == before and {d.name for d in spark.catalog.listDatabases()} == databases
    lease.release()
    assert warehouse_for(spark, SF_SMALL).mart_underserved().count() > 0


def test_the_shared_warehouse_is_nobodys(spark, tmp_path):
    shutil.copytree(SF_SMALL, tmp_path / "sf")
    with Lease(spark) as lease:
        marts = SPARK["q4_by_state"](spark, str(tmp_path / "sf"))
    lease.release()
    assert marts.count() > 0 and SPARK["q4_by_state"](spark, str(tmp_path / "sf")).count() > 0


def test_threads_and_inner_leases(spark):
    with Lease(spark) as outer:
        run_concurrently(lambda: materialize(spark.range(3), "a"), lambda: materialize(spark.range(4), "b"))
        with Lease(spark) as inner:
            kept = materialize(spark.range(5), "c")
        with under(None):
            free = fresh_dir(spark, "d")
    assert current_lease() is None
    assert len(outer.paths) == 2 and len(inner.paths) == 1 and free not in outer.paths
    paths = list(outer.paths)
    outer.release()
    assert not any(files.exists(spark, p) for p in paths) and kept.count() == 5
    inner.release()


def test_a_block_that_raises_leaves_nothing(spark):
    before = written(spark)
    with pytest.raises(ValueError):
        with Lease(spark):
            materialize(spark.range(3), "a")
            raise ValueError
    assert written(spark) == before and current_lease() is None


def test_a_namespace_that_was_there_is_not_dropped(spark):
    from gapscope.sinks.catalog import create_namespace
    name = "there_before"
    create_namespace(spark, name, fresh_dir(spark, name))
    with Lease(spark) as lease:
        create_namespace(spark, name)
    lease.release()
    assert spark.catalog.databaseExists(name)
    spark.sql(f"DROP DATABASE {name}")


def test_rewritten_input_is_seen(spark, tmp_path):
    sf = tmp_path / "sf"
    shutil.copytree(SF_SMALL, sf)
    before = SPARK["stg_county"](spark, str(sf))
    n = before.count()
    assert warehouse_for(spark, str(sf)) is warehouse_for(spark, str(sf))
    half = spark.read.parquet(f"{SF_SMALL}/customer.parquet").where("c_custkey % 2 = 0")
    (sf / "customer.parquet").unlink()
    half.write.parquet(str(sf / "customer.parquet"))
    assert 0 < SPARK["stg_county"](spark, str(sf)).count() < n
    assert before.count() == n   # what was planned before reads its own tables
