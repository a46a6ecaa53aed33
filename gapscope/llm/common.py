"""Helpers that the operators of this folder share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: a word is a run of characters other than these six white-space characters.
WORD_GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
_SPARING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns of these names (case-insensitive), so that an
    operator's own output columns never clash with what the input carries."""
    gone = {n.lower() for n in names}
    keep = [c for c in df.columns if c.lower() not in gone]
    return df if len(keep) == len(df.columns) else df.select(*[quoted(c) for c in keep])


def quoted(name: str) -> str:
    """A column name safe for resolution (dots and back-quotes are literal)."""
    return "`" + name.replace("`", "``") + "`"


def free_name(df: DataFrame, base: str) -> str:
    """``base``, or ``base`` with underscores put before it until no column has that name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = "_" + base
    return base


def words(text: Column) -> Column:
    """Array of the words of a text; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP), lambda w: w != "")


def held_out(doc_id: Column) -> Column:
    """True for the rows that no label may be learned from (null ids: false, they join no label)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def learning_labels(labels: DataFrame, column: str, bound: int) -> DataFrame:
    """At most ``bound`` labelled rows outside the held-out fold: (doc_id, label).

    A doc_id that is labelled more than once counts once, with its larger label.
    The rows kept are those of smallest hash, so the choice does not depend on
    partitioning; ``bound`` is what makes the result small enough to broadcast.
    """
    fold = (labels.select(F.col("doc_id"), F.col(column).cast("int").alias("label"))
            .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.max("label").alias("label")))
    return fold.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


@contextlib.contextmanager
def sparing_disk(spark: SparkSession) -> Iterator[None]:
    """Within, tables are written in zstd, and shuffle files of a query that writes its result go as soon as it is
    written, not when the driver collects garbage."""
    before = {key: spark.conf.get(key) for key in _SPARING}
    try:
        for key, value in _SPARING.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, if they see that folder.

    (In local mode, and on clusters with a shared code folder; else ship the package with ``--py-files``.)
    """
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))


def release() -> None:
    """At the end of a Python task: give freed memory back, as the worker stays and others start beside it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not with glibc
        ctypes.CDLL(None).malloc_trim(0)
