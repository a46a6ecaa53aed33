import zlib
from collections import Counter

from pyspark.sql import functions as F

from gapscope.llm import sharding
from gapscope.llm.queries import op5_sharding

from .conftest import SF


def held(rows, n_shards, n):
    counts = Counter(r.shard for r in rows)
    assert len(rows) == n and max(counts.values(), default=0) - min((counts.get(s, 0) for s in range(n_shards)), default=0) <= 1
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_query(spark, docs):
    rows = op5_sharding(spark, SF).collect()
    held(rows, 40, docs.count())
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "rows", None)


def test_query_writes_whole_records(spark, docs, monkeypatch):
    """What the query returns is read from written shards that hold every document whole."""
    written = []
    write = sharding.write_shards
    monkeypatch.setattr(sharding, "write_shards", lambda df, path, n, **kw: written.append(path) or write(df, path, n, **kw))
    rows = op5_sharding(spark, SF).collect()
    assert len(written) == 1
    stored = spark.read.parquet(written[0])
    assert Counter((r.doc_id, r.text) for r in stored.collect()) == Counter((r.doc_id, r.text) for r in docs.collect())
    assert {(r.doc_id, r.shard, r.slot) for r in stored.collect()} == {(r.doc_id, r.shard, r.slot) for r in rows}


def test_records_move_once_in_the_second_pass(spark, docs):
    plan = sharding.external_shuffle(docs.select("doc_id", "text", F.lit(20).cast("long").alias("size")), "size", bucket_bytes=500)
    shown = plan._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange" in line and "Single" not in line for line in shown.splitlines()) <= 2, shown  # the records, the counts of buckets


def test_same_rows_again_however_partitioned(spark, docs):
    df = docs.select("doc_id", F.lit(20).cast("long").alias("size"))
    first = {(r.doc_id, r.position) for r in sharding.external_shuffle(df, "size", bucket_bytes=500).collect()}
    second = {(r.doc_id, r.position) for r in sharding.external_shuffle(df.repartition(5, "doc_id"), "size", bucket_bytes=500).collect()}
    other = {(r.doc_id, r.position) for r in sharding.external_shuffle(df, "size", seed=18, bucket_bytes=500).collect()}
    assert first == second != other
    assert sorted(p for _, p in first) == list(range(docs.count()))


def test_more_buckets_than_tasks(spark, monkeypatch):
    monkeypatch.setattr(sharding, "TASKS", 3)
    df = spark.range(500).withColumn("size", F.lit(10).cast("long"))
    again = [sorted((r.id, r.position) for r in sharding.external_shuffle(df, "size", bucket_bytes=100).collect()) for _ in range(2)]
    assert again[0] == again[1] and sorted(p for _, p in again[0]) == list(range(500))


def test_buckets_are_taken_one_at_a_time(spark, tmp_path, monkeypatch):
    """A task with hundreds of buckets collects them in turn: its plan sorts and never hashes lists of records."""
    monkeypatch.setattr(sharding, "TASKS", 2)
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    with sharding.one_bucket_at_a_time(spark):
        shown = sharding.shards(df, 3, bucket_bytes=100)._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in shown and "SortAggregate" in shown
    sharding.write_shards(df, str(tmp_path / "out"), 3, bucket_bytes=100)
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    held(rows, 3, 3000)
    assert {r.doc_id for r in rows} == set(range(3000)) and spark.conf.get(sharding._SORTED) == "true"


def test_a_hot_record_is_numbered_where_it_is_read(spark):
    """A third of all rows are one record: every copy has a number of its own, whatever the partitions."""
    df = spark.range(900).repartition(6).select(F.when(F.col("id") < 300, -1).otherwise(F.col("id")).alias("id"), F.lit(10).cast("long").alias("size"))
    for rows in (df, df.coalesce(2)):
        numbered = sharding._numbered(rows, "size").collect()
        assert len(numbered) == 900 and sorted(r["copy"] for r in numbered if r.record.id == -1) == list(range(300))
        assert {r["copy"] for r in numbered if r.record.id != -1} == {0}


def test_shards_are_near_equal(spark):
    for n, n_shards in ((0, 3), (2, 5), (5, 5), (17, 5), (40, 1)):
        df = spark.range(n).withColumnRenamed("id", "position")
        held([r for r in sharding.deal(df, n_shards, n).collect()], n_shards, n)


def test_positions_are_uniform(spark):
    """Over seeds every record is at every place about equally often."""
    df = spark.range(4).withColumn("size", F.lit(1).cast("long"))
    at = Counter()
    for seed in range(60):
        at.update((r.id, r.position) for r in sharding.external_shuffle(df, "size", seed=seed, bucket_bytes=1000).collect())
    assert len(at) == 16 and all(4 <= n <= 28 for n in at.values())


def test_equal_rows_scatter(spark):
    """A third of all rows are one and the same; no bucket gets them all."""
    df = spark.range(900).select(F.when(F.col("id") < 300, -1).otherwise(F.col("id")).alias("id"), F.lit(10).cast("long").alias("size"))
    rows = sharding.external_shuffle(df, "size", bucket_bytes=1000).collect()
    places = sorted(r.position for r in rows if r.id == -1)
    assert len(places) == 300 and len(set(places)) == 300
    assert all(15 <= sum(a <= p < a + 90 for p in places) <= 50 for a in range(0, 900, 90))


def test_every_case_clashing_columns_and_files(spark, tricky, tmp_path):
    out = sharding.shards(tricky, 5)
    assert out.columns == [*[c for c in tricky.columns if c.lower() not in sharding.ADDED], *sharding.ADDED]
    rows = out.collect()
    held(rows, 5, tricky.count())
    assert sorted(map(str, out.select("doc_id", "text", "kept").collect())) == sorted(map(str, tricky.select("doc_id", "text", "kept").collect()))
    assert sharding.shards(tricky.limit(0), 5).count() == 0
    sharding.write_shards(tricky, str(tmp_path / "out"), 5)
    for shard in range(5):
        file = spark.read.parquet(str(tmp_path / "out" / f"shard={shard}"))
        slots = [r.slot for r in file.collect()]
        assert slots == list(range(len(slots))) and len(slots) == sum(r.shard == shard for r in rows)
