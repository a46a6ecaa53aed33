"""``RANK() OVER (ORDER BY key)`` with no PARTITION BY, without a single-task window
over the rows.

A window with no partition moves every row into one task.  Rank only needs,
for each key value, how many rows sort strictly before it, so the plan is:

1. ``hist``: ``groupBy(key).count()`` — partial aggregation map-side, so a
   key holding a third of the rows is one partial row per map task.  It is
   written as a table in the shared folder; its footers give the exact
   number ``H`` of distinct keys.
2. Running "rows before" over ``hist`` in key order:

   * ``H`` within ``single_task_max_keys`` (a proven bound, e.g. percentages
     rounded to two decimals have at most 10,001 values): one window task
     over the ``H``-row histogram;
   * otherwise: the histogram is range-partitioned (and written, with its
     partition ids, so every later use sees the same split — range bounds
     come from sampling and shuffle order is not deterministic), running
     counts are taken inside each range, and each range's offset comes from
     a window over the ``P`` range totals (broadcast, ``P`` partitions).

3. Join the ``H`` key ranks back to the rows on the key (null-safe):
   broadcast when ``H`` is small, else a shuffle join.

When the caller proves a small bound on ``H`` up front (``key_bound``), step
1's table is skipped and the whole rank is one lazy job.

Ties share a rank and leave gaps (SQL RANK); NULL keys sort as asked
(last by default, as in the reference for both directions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .join import BROADCAST_MAX_BYTES, bounded_broadcast

_N, _PID, _BEFORE, _OFF = "__rk_n", "__rk_pid", "__rk_before", "__rk_off"

# Largest histogram ranked inside one window task.
SINGLE_TASK_MAX_KEYS = 1_000_000


def _order(key: str, ascending: bool, nulls_last: bool):
    c = F.col(key)
    if ascending:
        return c.asc_nulls_last() if nulls_last else c.asc_nulls_first()
    return c.desc_nulls_last() if nulls_last else c.desc_nulls_first()


def _rows_before(order, partition: str | None = None):
    w = Window.partitionBy(partition) if partition else Window
    frame = w.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(_N).over(frame), F.lit(0))


def key_ranks(df: DataFrame, key: str, ascending: bool = False,
              nulls_last: bool = True, rank_col: str = "rank",
              partitions: int | None = None,
              single_task_max_keys: int = SINGLE_TASK_MAX_KEYS) -> DataFrame:
    """One row per distinct ``key`` value with its SQL RANK (bigint)."""
    return _key_ranks(df, key, ascending, nulls_last, rank_col, partitions,
                      single_task_max_keys)


def _key_ranks(df: DataFrame, key: str, ascending: bool, nulls_last: bool,
               rank_col: str, partitions: int | None,
               single_task_max_keys: int) -> DataFrame:
    order = _order(key, ascending, nulls_last)
    hist = materialize(df.groupBy(key).agg(F.count(F.lit(1)).alias(_N)), "rank-hist")
    n_keys = hist.count()          # parquet footers: cheap and exact
    if n_keys <= single_task_max_keys:
        ranks = hist.select(key, (_rows_before(order) + 1).cast("long").alias(rank_col))
        return ranks
    # Without an explicit count AQE may coalesce neighbouring ranges, which
    # keeps them contiguous, so partition ids stay in key order.
    ranged_hist = (hist.repartitionByRange(partitions, order) if partitions
                   else hist.repartitionByRange(order))
    ranged = materialize(ranged_hist.withColumn(_PID, F.spark_partition_id()), "rank-ranges")
    local = ranged.withColumn(_BEFORE, _rows_before(order, _PID))
    offsets = (ranged.groupBy(_PID).agg(F.sum(_N).alias(_N))
               .withColumn(_OFF, _rows_before(F.col(_PID)))
               .select(_PID, _OFF))
    # offsets has one row per range partition: a proven bound, safe to broadcast.
    ranks = (local.join(F.broadcast(offsets), _PID)
             .select(key, (F.col(_OFF) + F.col(_BEFORE) + 1).cast("long").alias(rank_col)))
    return ranks


def global_rank(df: DataFrame, key: str, ascending: bool = False,
                nulls_last: bool = True, rank_col: str = "rank",
                broadcast_max_bytes: int = BROADCAST_MAX_BYTES,
                partitions: int | None = None,
                single_task_max_keys: int = SINGLE_TASK_MAX_KEYS,
                key_bound: int | None = None) -> DataFrame:
    """``df`` plus ``rank_col`` = RANK() OVER (ORDER BY key ...).

    ``key_bound`` is an upper bound on the number of distinct keys that the
    caller has already proven (e.g. rows bounded by a dimension's row count).
    Within the single-task and broadcast limits the histogram then stays
    lazy: one window over at most that many rows, broadcast back, one job.
    """
    if key_bound is not None and key_bound <= single_task_max_keys:
        order = _order(key, ascending, nulls_last)
        hist = df.groupBy(key).agg(F.count(F.lit(1)).alias(_N))
        ranks = hist.select(F.col(key).alias("__rk_key"),
                            (_rows_before(order) + 1).cast("long").alias(rank_col))
        r = bounded_broadcast(ranks, key_bound, broadcast_max_bytes)
        return df.join(r, df[key].eqNullSafe(r["__rk_key"]), "inner").drop("__rk_key")
    ranks = _key_ranks(df, key, ascending, nulls_last, rank_col, partitions,
                       single_task_max_keys)
    r = bounded_broadcast(ranks.withColumnRenamed(key, "__rk_key"), max_bytes=broadcast_max_bytes)
    return (df.join(r, df[key].eqNullSafe(r["__rk_key"]), "inner")
            .drop("__rk_key"))
