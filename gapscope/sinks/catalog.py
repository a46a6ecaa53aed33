"""Catalog steps of the batch job: namespaces, views and replaced tables.

A replaced table is a name for its present version: every version is a folder of
its own under the table's path, and the name is moved to a new one in one step,
whatever its schema.  Versions that were replaced stay for those who still read them;
``sweep`` removes them later.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import files
from ..session import current_lease

_VERSION = "gapscope.version"
_REPLACED, _LEASES = "_replaced", "_leases"
#: Seconds that a replaced version stays, that a lease holds at most, and after which an unfinished version is given up.
KEEP, LEASE, GIVEN_UP = 86_400.0, 86_400.0, 86_400.0


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` (optionally placed in the shared folder); a new one belongs to the current lease."""
    if (lease := current_lease()) and not spark.catalog.databaseExists(name):
        lease.namespaces.append(name)
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{loc}")


def current_version(spark: SparkSession, table: str) -> str | None:
    """Folder of the version that a replaced table names now."""
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == _VERSION).collect()
    return rows[0].value if rows else None


def replace_table(df: DataFrame, table: str, path: str, keep: float = KEEP,
                  accept: Callable[[int], None] | None = None) -> DataFrame:
    """``CREATE OR REPLACE TABLE .. AS SELECT``: a new version under ``path``, then the name moves to it.

    If writing fails, or ``accept`` (called with the rows, which are counted while
    they are written) raises, the table keeps its old version.  The name is moved
    by one replacement of its definition, also to another schema, so it is never
    absent.  Who planned a read before goes on with the old version, which stays
    for ``keep`` seconds at least and as long as somebody holds it (``reading``).
    """
    spark = df.sparkSession
    version = f"{path.rstrip('/')}/v-{uuid.uuid4().hex[:12]}"
    seen = Observation()
    try:
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(version)
        if accept is not None:
            accept(int(seen.get.get("rows", 0)))
        name_version(spark, table, version)
    except Exception:
        files.delete(spark, version)
        raise
    sweep(spark, table, path, keep)
    return spark.table(table)


def name_version(spark: SparkSession, table: str, version: str) -> None:
    """Lets ``table`` name a written version; the one that it named before is marked as replaced."""
    old = current_version(spark, table)
    if old == version:
        return
    if old is None:
        spark.sql(f"DROP TABLE IF EXISTS {table}")   # of another kind: made by other means
    spark.sql(f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ('{_VERSION}' = '{version}') AS SELECT * FROM parquet.`{version}`")
    if old and files.exists(spark, old):
        files.touch(spark, f"{old}/{_REPLACED}")


@contextmanager
def reading(spark: SparkSession, table: str) -> Iterator[DataFrame]:
    """The table's rows as they are now, for as long as the block lasts (at most ``LEASE`` seconds): no sweep removes them."""
    version = current_version(spark, table)
    if version is None:
        yield spark.table(table)
        return
    folder, name = version.rsplit("/", 1)
    lease = f"{folder}/{_LEASES}/{name}.{uuid.uuid4().hex[:12]}"
    files.touch(spark, lease)
    try:
        yield spark.read.parquet(version)
    finally:
        files.delete(spark, lease)


def sweep(spark: SparkSession, table: str, path: str, keep: float = KEEP) -> list[str]:
    """Removes versions that were replaced over ``keep`` seconds ago and that nobody holds; returns their names.

    Versions that were never finished go once they are older than ``GIVEN_UP``.
    """
    current = (current_version(spark, table) or "").rsplit("/", 1)[-1]
    now = files.now()
    held = {e.name.split(".")[0] for e in files.entries(spark, f"{path.rstrip('/')}/{_LEASES}") if now - e.modified < LEASE}
    gone = []
    for version in files.entries(spark, path):
        if not version.name.startswith("v-") or version.name == current or version.name in held:
            continue
        inside = {e.name: e.modified for e in files.entries(spark, version.path)}
        newest = max(inside.values(), default=version.modified)
        over = now - inside[_REPLACED] >= keep if _REPLACED in inside else now - newest >= GIVEN_UP
        if over:
            files.delete(spark, version.path)
            gone.append(version.name)
    return gone


def replace_view(spark: SparkSession, name: str, query: str) -> DataFrame:
    """``CREATE OR REPLACE VIEW name AS query``: a lazy relation in its namespace, which other sessions see."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
    return spark.table(name)
