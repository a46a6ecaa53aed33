"""Join helpers: broadcast only behind a size check, otherwise shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest dimension side we are willing to ship to every executor.
BROADCAST_MAX_BYTES = 64 << 20
# What a row of a dimension with a known row bound is taken to need.
DIMENSION_ROW_BYTES = 1024


def measured_bytes(df: DataFrame) -> DataFrame:
    """One row with the bytes of all values: text by its length, other columns by
    their type's width.  A partial aggregate per task; no row moves."""
    width = F.lit(8)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width += F.coalesce(F.octet_length(c), F.lit(0)) + 16
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width += F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 16
        else:
            width += 16
    return df.agg(F.coalesce(F.sum(width.cast("long")), F.lit(0)).alias("bytes"))


def bounded_broadcast(df: DataFrame, known_bound: int | None = None,
                      max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast-hint ``df`` only if its size is proven to be small.

    ``known_bound`` is an upper bound on its rows that the caller has already
    established (e.g. a dimension table's footer count that a group-by key
    ranges over).  Without one, its bytes are measured (``measured_bytes``).
    Above the limit the frame is returned unhinted and the join shuffles
    (AQE may still switch to a broadcast from runtime statistics).
    """
    size = known_bound * DIMENSION_ROW_BYTES if known_bound is not None else measured_bytes(df).first().bytes
    return F.broadcast(df) if size <= max_bytes else df


def enrich_left(left: DataFrame, right: DataFrame, key: str,
                right_bound: int | None = None,
                max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Left outer equi-join that keeps every left row (misses get NULLs).

    The right side is a per-key lookup (unique ``key``).  When its size is
    bounded it is broadcast, so the (large) left side is never shuffled and
    a hot key on the left costs nothing extra; otherwise a sort-merge join
    whose skewed left partitions AQE splits.
    """
    return left.join(bounded_broadcast(right, right_bound, max_bytes), on=key, how="left")

