"""Readers for the parquet test tables, with the projection pushed to the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read one table; naming ``columns`` keeps the parquet ReadSchema narrow."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def row_count(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Row count of a table (parquet footers answer this without a data scan)."""
    return spark.read.parquet(table_path(sf_dir, name)).count()
