import os

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
TRICKY = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from it.", "en", "src1"),
    (1, "The quick brown fox jumps over the lazy dog and runs away from it.", "en", "src1"),  # a repeated row
    (2, None, "en", "src1"),
    (3, "", None, None),
    (4, " \t\n\r\x0b\x0c ", "en", "src2"),
    (None, "The quick brown fox jumps over the lazy dog and runs away from it.", "en", None),
    (5, "long word " * 30_000, "en", "src2"),  # 300,000 characters
    (6, "x" * 50_000, "de", "src3"),
    (7, "日本語 é́ ñandú 🏳️‍🌈 naïve\x1c\x85\xa0end", "es", "src2"),
    (8, "<|endoftext|> a <|endoftext|><|endoftext|>\n\n\nb", "en", "src3"),
    (9, "one", "en", "src9"),
    (None, None, None, None),
]
#: Names that operators add, so that the input's own columns clash with them.
CLASHING = ["Score", "ids", "DECODED", "kept", "n_words", "size", "Target", "taken", "copies", "finish", "shard", "slot", "position",
            "node", "label", "Class_ID", "section", "n_tokens", "mix_row", "dup_node", "pu_score", "rule_stats", "bucket"]


@pytest.fixture(scope="session")
def tricky(spark):
    df = spark.createDataFrame(TRICKY, "doc_id long, text string, lang string, source string")
    return df.withColumn("n_chars", F.length("text").cast("long")).withColumns({c: F.lit(f"own {c}") for c in CLASHING}).cache()


@pytest.fixture(scope="session")
def plain(tricky):
    return tricky.select("doc_id", "text", "lang", "source", "n_chars")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(os.path.join(SF, "documents.parquet")).cache()


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(os.path.join(SF, "labels.parquet"))
