"""Sharding by a two-pass external shuffle.

Pass 1 scatters records by a seeded hash into buckets that fit in memory; pass 2
shuffles every bucket by Fisher-Yates (Spark's ``shuffle`` of an array) and
numbers the records one bucket after another.  The number is a uniform random
position among all records, and a shard is a stretch of positions: counts are at most
one apart, a shard is a random sample in random order, and a task of pass 2 writes its
buckets' records straight into their shards.

Equal records are numbered before they are scattered, by the partitions that they are
read in, so that a record that a third of all rows repeat spreads like different ones
and is never expanded from a count in one task.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gapscope.llm.common import quoted, sparing_disk, without
from gapscope.session import Scratch, materialize

BUCKET_BYTES = 16 << 20
#: Tasks of the second pass at most; a task takes its buckets (neighbours) one by one.
TASKS = 4096
_SORTED = "spark.sql.execution.useObjectHashAggregateExec"
ADDED = ("size", "text_crc32", "position", "shard", "slot")


def record_bytes(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long")


@contextlib.contextmanager
def one_bucket_at_a_time(spark: SparkSession) -> Iterator[None]:
    """What runs within collects the records of one bucket after the other (sorted), not of many at once (hashed)."""
    before = spark.conf.get(_SORTED)
    try:
        spark.conf.set(_SORTED, "false")
        yield
    finally:
        spark.conf.set(_SORTED, before)


def _numbered(df: DataFrame, size: str) -> DataFrame:
    """(record, bytes, key, copy): the rows with a number for each copy of a record, from 0.

    Rows of a record are counted by partition; those of a partition take the numbers after the partitions before it.
    Numbers only spread equal records: were the partitions others at a second reading, two copies might share one.
    """
    columns = [quoted(c) for c in df.columns]
    rows = df.select(F.struct(*columns).alias("record"), F.col(size).alias("bytes"), F.spark_partition_id().alias("part"))
    rows = rows.withColumn("key", F.xxhash64("record"))
    chunks = rows.groupBy("key", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("earlier", F.sum("n").over(earlier)).where(F.col("earlier").isNotNull()).drop("n")
    among = F.row_number().over(Window.partitionBy("key", "part").orderBy("key"))
    return rows.withColumn("among", among).join(chunks, ["key", "part"], "left").select(
        "record", "bytes", "key", (F.coalesce("earlier", F.lit(0)) + F.col("among") - 1).alias("copy"))


def external_shuffle(df: DataFrame, size: str, seed: int = 17, bucket_bytes: int = BUCKET_BYTES,
                     write: Callable[[DataFrame, str], DataFrame] = materialize) -> DataFrame:
    """Rows of ``df`` with column ``position``: a seeded random permutation from 0, the same on every run.

    ``size`` names the column with a row's bytes; buckets hold about
    ``bucket_bytes``.  Columns must be comparable (no maps).  ``write`` keeps the
    scattered records between the passes.  Use the result inside
    ``one_bucket_at_a_time`` where tasks have many buckets.
    """
    total = df.agg(F.sum(size).alias("b")).first().b or 0
    n = max(1, -(-total // bucket_bytes))
    tasks = min(n, TASKS)
    # pass 1: every record goes to a bucket
    bucket = F.pmod(F.xxhash64(F.lit(seed), "key", "copy"), F.lit(n))
    scattered = write(_numbered(df, size).select(bucket.alias("bucket"), "record", "copy"), "shuffle-scattered")
    counts = scattered.groupBy("bucket").agg(F.count("*").alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    # pass 2: records move once, their bucket's offset with them; a fixed order within buckets and of buckets within
    # tasks, so that the seeded shuffle repeats itself
    task = F.floor(F.col("bucket") * tasks / F.lit(n)).cast("int").alias("task")
    moved = scattered.select(task, "bucket", F.struct("record", "copy").alias("one")).unionByName(
        offsets.select(task, "bucket", "offset"), allowMissingColumns=True).repartitionById(tasks, "task")
    full = moved.groupBy("task", "bucket").agg(F.sort_array(F.collect_list("one")).alias("records"), F.max("offset").alias("offset"))
    full = full.sortWithinPartitions("bucket")
    dealt = full.select("offset", F.shuffle("records", seed).alias("records"))
    dealt = dealt.select("offset", F.posexplode("records").alias("place", "one"))
    return dealt.select("one.record.*", (F.col("offset") + F.col("place")).alias("position"))


def shards(df: DataFrame, n_shards: int, text: str = "text", seed: int = 17, bucket_bytes: int = BUCKET_BYTES,
           write: Callable[[DataFrame, str], DataFrame] = materialize) -> DataFrame:
    """Adds size, text_crc32, position, shard and slot to every row.

    size: UTF-8 bytes of the text (null: none) plus 16; text_crc32: of the text's
    UTF-8 bytes (null: as empty).  Row counts of shards are at most one apart and
    slots count from 0 without gaps.  Repeated rows all stay, each in a place of
    its own; an empty table gives an empty result; input columns named like the
    added ones are replaced, others stay (if they can be compared; no maps).
    """
    body = F.col(quoted(text))
    sized = without(df, *ADDED).withColumns({"size": record_bytes(body), "text_crc32": F.crc32(F.coalesce(body, F.lit("")))})
    kept = []

    def kept_rows(scattered: DataFrame, label: str) -> DataFrame:
        kept.append(write(scattered, label))
        return kept[0]

    shuffled = external_shuffle(sized, "size", seed, bucket_bytes, kept_rows)
    return deal(shuffled, n_shards, kept[0].count())   # from the written files' footers


def deal(shuffled: DataFrame, n_shards: int, n_rows: int) -> DataFrame:
    """Adds shard and slot: stretches of ``n_rows`` positions, the first ones a row longer where they do not come out even."""
    least, longer = divmod(n_rows, n_shards)
    position, edge = F.col("position"), longer * (least + 1)
    rest = position - edge
    return shuffled.withColumns({
        "shard": F.when(position < edge, F.floor(position / (least + 1))).otherwise(longer + F.floor(rest / max(1, least))).cast("int"),
        "slot": F.when(position < edge, position % (least + 1)).otherwise(rest % max(1, least)).cast("long")})


def write_shards(df: DataFrame, path: str, n_shards: int, **options) -> None:
    """Writes the rows as ``path/shard=N`` Parquet folders (columns as given, and slot); a shard's files, in the order of
    their names, hold its slots in order.

    The second pass writes the shards itself; the scattered records are removed after it.
    """
    spark = df.sparkSession
    with Scratch(spark) as scratch, sparing_disk(spark), one_bucket_at_a_time(spark):
        out = shards(df, n_shards, write=scratch.write, **options).drop("size", "text_crc32", "position")
        out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").mode("errorifexists").parquet(path)
