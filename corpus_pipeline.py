"""Training-data pipeline over ``documents``: five stages, each over all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gapscope.llm import bpe, mixing, near_dup, quality_pu, quality_rules
from gapscope.llm.common import quoted, table
from gapscope.llm.queries import vocabulary
from gapscope.session import materialize


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.judge_quality(docs).where("kept").select(*map(quoted, docs.columns))


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more, by a scorer learned from these documents and the trusted labels."""
    scorer, _ = quality_pu.learn(docs, table(spark, sf_dir, "labels"))
    return quality_pu.keep_good(docs, scorer)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dup.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: documents as often as it takes them (some not, some twice), in its order."""
    return mixing.mixture(docs)


def encode_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and what they decode to."""
    return bpe.encode_decode(docs, vocabulary())


STAGES = [("quality rules", rules), ("quality classifier", classifier), ("near-duplicates", deduplicate),
          ("mixing", mix), ("bpe", encode_decode)]

#: The classifier, the sampled signatures and the estimated rules have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
