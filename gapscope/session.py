"""Session construction and shared scratch locations.

Everything that must survive an executor loss (checkpoints, landed files,
raw/mart tables) goes under the folder the cluster names in
``spark.checkpoint.dir``.  Only when that setting is absent (local tests)
do we create one ourselves.
"""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import Any

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "gapscope",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session with the settings this engine is tuned for.

    AQE stays on (runtime coalescing, skew-join splitting, SMJ→BHJ when a
    shuffled side turns out small).  Size shuffles with ``shuffle_partitions``
    or, from the input bytes, with ``apply_scale_settings``; left unset,
    Spark's default applies.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a local SparkContext
        configured = spark.conf.get(_CKPT_KEY, None)
        if not configured:
            raise RuntimeError(f"{_CKPT_KEY} must name a shared folder") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get(_CKPT_KEY, None)
    if not configured:
        if not sc.master.startswith("local"):
            # a machine-local folder would not survive the loss of that machine
            raise RuntimeError(f"{_CKPT_KEY} must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="gapscope-ckpt-")   # local mode (tests) only
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unique (not yet created) path under the shared checkpoint location."""
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
    if lease := current_lease():
        lease.paths.append(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as a parquet table in the shared folder and read it back.

    Cuts lineage like a reliable checkpoint, but computes the plan once
    (an eager ``checkpoint()`` runs it for the count and again for the
    write) and keeps columnar pruning and footer statistics for readers.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.parquet(path)
    return spark.read.parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared store (through Hadoop, so any store Spark can write)."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class Lease:
    """What is written under the shared folder inside its ``with`` block, for as long as the block's results are needed.

    The block's own thread and those of ``run_concurrently`` are covered; of blocks
    within each other, the inner one has what is written in it.  Leaving the block
    removes nothing, as results may still read from there; ``release`` does: afterwards no
    result made in the block can be read.  If the block raises, all goes at once.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []
        self.namespaces: list[str] = []
        self._within: list[contextlib.AbstractContextManager] = []

    def __enter__(self) -> Lease:
        self._within.append(under(self))
        self._within[-1].__enter__()
        return self

    def __exit__(self, error, *_) -> None:
        self._within.pop().__exit__(None, None, None)
        if error is not None:
            self.release()

    def release(self) -> None:
        """Removes the namespaces and folders of the block; a second call does nothing."""
        while self.namespaces:
            self.spark.sql(f"DROP DATABASE IF EXISTS `{self.namespaces.pop()}` CASCADE")
        while self.paths:
            delete_path(self.spark, self.paths.pop())


_LEASE: contextvars.ContextVar[Lease | None] = contextvars.ContextVar("lease", default=None)


def current_lease() -> Lease | None:
    return _LEASE.get()


@contextlib.contextmanager
def under(lease: Lease | None) -> Iterator[None]:
    """What is written within belongs to ``lease``, or (None) to nobody, as what later callers share does."""
    before = _LEASE.set(lease)
    try:
        yield
    finally:
        _LEASE.reset(before)


class Scratch:
    """Intermediate tables of one computation, removed when it is done with them.

    ``write`` materializes a DataFrame under the shared folder; on leaving the
    ``with`` block every table that was not handed to ``keep`` is deleted, also
    after an error.  Only what no longer depends on a table may outlive it.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._paths: dict[int, tuple[DataFrame, str]] = {}

    def write(self, df: DataFrame, label: str) -> DataFrame:
        path = fresh_dir(self.spark, label)
        df.write.parquet(path)
        table = self.spark.read.parquet(path)
        self._paths[id(table)] = table, path
        return table

    def keep(self, table: DataFrame) -> DataFrame:
        self._paths.pop(id(table), None)
        return table

    def drop(self, table: DataFrame) -> None:
        _, path = self._paths.pop(id(table))
        delete_path(self.spark, path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        for _, path in self._paths.values():
            delete_path(self.spark, path)
        self._paths.clear()


def run_concurrently(*tasks: Callable[[], Any]) -> list[Any]:
    """Run independent driver-side steps (each submitting its own Spark jobs)
    at once, so a small job (the region branch) overlaps a large one instead
    of queueing behind it.  Returns results in order; re-raises the first error.
    """
    results: list[Any] = [None] * len(tasks)
    errors: list[BaseException] = []

    def runner(i: int, fn: Callable[[], Any]) -> None:
        try:
            results[i] = fn()
        except BaseException as e:  # noqa: BLE001 - re-raised below
            errors.append(e)

    threads = [InheritableThread(target=contextvars.copy_context().run, args=(runner, i, fn)) for i, fn in enumerate(tasks)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if errors:
        raise errors[0]
    return results


def projected_bytes(df: DataFrame) -> int:
    """Spark's own estimate of what ``df`` reads: its files' bytes, times the share of the columns it selects."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def scale_settings(projected: int, total_cores: int,
                   max_partition_bytes: int = 2 << 30,
                   min_partition_bytes: int = 1 << 20) -> dict[str, str]:
    """Shuffle / split sizing for a job that reads ``projected`` bytes (of the columns it needs).

    At least two waves of tasks, each partition between ``min`` and ``max``
    bytes; scan splits are as large as shuffle partitions (up to 1 GiB), so
    that with growing input neither maps nor reduces, nor the blocks between
    them, grow faster than bytes / 2 GiB.  At the upper end push-based shuffle
    (``spark.shuffle.push.enabled``) merges a reducer's blocks before it reads
    them.  AQE coalesces small partitions and splits skewed ones at runtime.
    """
    target = projected // max(1, 2 * total_cores)
    target = max(min_partition_bytes, min(max_partition_bytes, target))
    parts = max(2 * total_cores, -(-projected // target))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(min(target, 1 << 30)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target),
    }


# the columns that the widest shuffles of the batch job carry
SHUFFLED = {"lineitem": ("l_orderkey", "l_quantity", "l_discount"), "orders": ("o_orderkey", "o_custkey"),
            "customer": ("c_custkey", "c_name", "c_nationkey")}


def apply_scale_settings(spark: SparkSession, sf_dir: str, total_cores: int,
                         tables: dict[str, tuple[str, ...]] = SHUFFLED) -> dict[str, str]:
    """Size the session for the given columns of the tables under ``sf_dir`` (runtime SQL confs only)."""
    projected = sum(projected_bytes(spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet").select(*columns))
                    for t, columns in tables.items())
    conf = scale_settings(projected, total_cores)
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf


def app_id(spark: SparkSession) -> str:
    """Identifier of the running application (per-application memoisation)."""
    return spark.conf.get("spark.app.id", None) or spark.conf.get("spark.app.name")
