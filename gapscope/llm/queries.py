"""Registered queries of this folder: production parameters, whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from gapscope.llm import bpe, chat_format, filter_audit, mixing, near_dup, quality_pu, quality_rules, sharding, source_audit, token_counts, topk, toxicity, url_filter
from gapscope.llm.common import held_out, table
from gapscope.session import fresh_dir, materialize


def vocabulary(name: str = "byte_bpe_50k.json", folder: str | None = None) -> str:
    """Path of a vocabulary file, in ``folder`` or where the package has it; it is read where the tasks run."""
    if folder is not None:
        return os.path.join(folder, name)
    import public_tokenizers  # needed by the queries of two operators only
    return public_tokenizers.path(name)


def op1_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scorer, _ = quality_pu.learn(docs, table(spark, sf_dir, "labels"))
    scored = quality_pu.score_quality(docs, scorer)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_rules.judge_quality(docs, carry=["doc_id"]).select("doc_id", *quality_rules.ADDED)
    return judged.withColumn("quality_posterior", F.round("quality_posterior", 6))  # sums of doubles differ by their order


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score_toxicity(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages).select("page_id", "host", "path", "rule", "verdict", "score")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = fresh_dir(spark, "shards")
    sharding.write_shards(docs, path, 40)
    written = spark.read.schema(StructType([*docs.schema, StructField("slot", LongType()), StructField("shard", IntegerType())])).parquet(path)
    return written.select("doc_id", sharding.record_bytes(F.col("text")).alias("size"),
                          F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
                          F.lit(None).cast("int").alias("grown_shard"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan_mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    own = materialize(planned.rows.select("mix_id", f"{planned.row}.doc_id"), "mix-ids")
    path = fresh_dir(spark, "mixture")
    mixing.write_mixture(planned, path, release=True)
    mixed = spark.read.schema("doc_id long, text string, source string, mix_id long").parquet(path)
    return mixing.taken_words(planned, own, mixed)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary())


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.attribute_tokens(table(spark, sf_dir, "documents"), vocabulary(), ["doc_id"])


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit_sources(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(filter_audit.failure_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-1, 0, "user", chat_format.PLANTED), (-1, 1, "assistant", chat_format.PLANTED)], turns.schema)
    return chat_format.read_back(chat_format.format_chats(turns.unionByName(planted)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_pu": op1_quality_pu,
    "op2_quality_rules": op2_quality_rules,
    "op3_toxicity": op3_toxicity,
    "op4_url_filter": op4_url_filter,
    "op5_sharding": op5_sharding,
    "op6_topk": op6_topk,
    "op7_near_dup": op7_near_dup,
    "op8_mixing": op8_mixing,
    "op9_bpe": op9_bpe,
    "op10_token_counts": op10_token_counts,
    "op11_source_audit": op11_source_audit,
    "op12_filter_audit": op12_filter_audit,
    "op13_chat_format": op13_chat_format,
}
ORACLE: dict[str, str] = {"op2_quality_rules": quality_rules.ORACLE, "op6_topk": topk.ORACLE, "op8_mixing": mixing.ORACLE,
                          "op11_source_audit": source_audit.ORACLE, "op12_filter_audit": filter_audit.ORACLE, "op13_chat_format": chat_format.ORACLE}
