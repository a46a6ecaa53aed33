"""Writers: landed responses and CSV snapshots, run manifest, full-refresh
loads and mart exports.  All writes are distributed DataFrame writes into
the shared folder; nothing passes through the driver."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import files
from ..sources.households import COUNT_COLUMNS
from ..sources.landing import CENSUS_VARIABLES
from .catalog import replace_table

PIPELINE_VERSION = "1.0.0"
TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

MANIFEST_SCHEMA = T.StructType([
    T.StructField("run_timestamp", T.StringType()),
    T.StructField("pipeline_version", T.StringType()),
    T.StructField("datasets", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("columns", T.ArrayType(T.StringType())),
        T.StructField("file", T.StringType()),
    ]))),
])


def snapshot_path(directory: str, name: str, run_id: str) -> str:
    return f"{directory.rstrip('/')}/{name}_{run_id}.csv"


# cells are written as they are: blanks at their ends stay
CSV_WRITE = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False,
             "ignoreTrailingWhiteSpace": False, "timestampFormat": TS_FORMAT,
             "timestampNTZFormat": TS_FORMAT}
# a cell may hold newlines, so a file is read by one task: bound its rows
ROWS_PER_FILE = 500_000


def land_csv(df: DataFrame, directory: str, name: str, run_id: str) -> str:
    """Immutable timestamped snapshot ``<name>_<run>.csv`` (refuses to overwrite)."""
    path = snapshot_path(directory, name, run_id)
    (df.write.mode("errorifexists").options(**CSV_WRITE)
     .option("maxRecordsPerFile", ROWS_PER_FILE).csv(path))
    return path


def land_api_responses(raw: DataFrame, path: str, geo_keys: list[str],
                       rows_per_doc: int = 5000,
                       unparsable: Column | None = None,
                       unparsable_column: str = "households_fiber_optic",
                       n_rows: int | None = None) -> str:
    """Write a raw relation back out as census-style response documents.

    Cells become text (counts as whole numbers, NULL stays JSON null); rows
    are spread over ``ceil(n / rows_per_doc)`` documents by a hash of the
    geography key, so a hot region never makes one oversized document.
    ``unparsable`` (a predicate) replaces ``unparsable_column`` with ``'x'``.
    ``n_rows`` (an upper bound on the rows, if already known) spares a count.
    """
    codes = {v: k for k, v in CENSUS_VARIABLES.items()}
    header = [codes[c] for c in COUNT_COLUMNS] + ["NAME", *geo_keys]

    def count_text(c: str) -> Column:
        t = F.col(c).cast("long").cast("string")
        if unparsable is not None and c == unparsable_column:
            t = F.when(unparsable, F.lit("x")).otherwise(t)
        return t

    cells = F.array(*[count_text(c) for c in COUNT_COLUMNS], F.col("geography_name"),
                    *[F.col(k) for k in geo_keys])
    n = n_rows if n_rows is not None else raw.count()
    n_docs = max(1, -(-n // rows_per_doc))
    doc = F.concat(F.array(F.array(*[F.lit(h) for h in header])), F.collect_list(cells))
    (raw.groupBy(F.pmod(F.xxhash64(*geo_keys), F.lit(n_docs)).alias("doc_id"))
     .agg(F.to_json(doc).alias("value"))
     .select("value").write.mode("errorifexists").text(path))
    return path


def dataset_record(landed: DataFrame, name: str, source: str, file: str) -> DataFrame:
    """One manifest entry; the row count is a distributed aggregate."""
    return landed.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("name"), F.lit(source).alias("source"), "rows",
        F.array(*[F.lit(c) for c in landed.columns]).alias("columns"),
        F.lit(file).alias("file"))


def known_record(spark: SparkSession, name: str, source: str, rows: int, columns: list[str], file: str) -> DataFrame:
    """One manifest entry of a dataset whose rows were counted while it was written."""
    return spark.createDataFrame([(name, source, rows, columns, file)],
                                 "name string, source string, rows long, columns array<string>, file string")


def write_manifest(spark: SparkSession, directory: str, run_id: str,
                   records: list[DataFrame]) -> str:
    """``manifest_<run>.json``: run id, version and the dataset records."""
    path = f"{directory.rstrip('/')}/manifest_{run_id}.json"
    entries = reduce(DataFrame.unionByName, records)
    manifest = entries.agg(F.collect_list(F.struct("name", "source", "rows", "columns", "file"))
                           .alias("datasets")).select(
        F.lit(run_id).alias("run_timestamp"), F.lit(PIPELINE_VERSION).alias("pipeline_version"),
        "datasets")
    manifest.write.mode("errorifexists").json(path)
    return path


def write_known_manifest(spark: SparkSession, directory: str, run_id: str,
                         records: list[tuple[str, str, int, list[str], str]]) -> str:
    """``write_manifest`` of entries (name, source, rows, columns, file) that are known to the driver: no job but the write."""
    path = f"{directory.rstrip('/')}/manifest_{run_id}.json"
    whole = spark.createDataFrame([(run_id, PIPELINE_VERSION, records)], MANIFEST_SCHEMA)
    whole.coalesce(1).write.mode("errorifexists").json(path)
    return path


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).json(path)


def newest_recorded(spark: SparkSession, directory: str, name: str) -> tuple[str, int] | None:
    """(snapshot, rows) of a dataset as the newest finished manifest that has it says; None if none does.

    A manifest is written after its snapshots, so what it names is complete; one
    without its ``_SUCCESS`` marker is of a run that did not finish.
    """
    for entry in reversed(files.entries(spark, directory)):
        if not (entry.name.startswith("manifest_") and entry.name.endswith(".json") and files.exists(spark, f"{entry.path}/_SUCCESS")):
            continue
        found = (read_manifest(spark, entry.path).select(F.explode("datasets").alias("d"))
                 .where(F.col("d.name") == name).select("d.file", "d.rows").head(1))
        if found:
            return found[0]["file"], found[0]["rows"]
    return None


def as_recorded(name: str, snapshot: str, rows: int) -> Callable[[int], None]:
    """Refuses a load whose rows are not those that the manifest recorded."""
    def accept(loaded: int) -> None:
        if loaded != rows:
            raise ValueError(f"{name}: {snapshot} has {loaded} rows, its manifest says {rows}")
    return accept


def load_full_refresh(df: DataFrame, table: str, path: str, loaded_at: str,
                      accept: Callable[[int], None] | None = None) -> DataFrame:
    """DROP + CREATE AS SELECT equivalent: stamp ``loaded_at``, replace the catalog table (if ``accept`` lets its rows)."""
    return replace_table(df.withColumn("loaded_at", F.lit(loaded_at)), table, path, accept=accept)


def export_csv(df: DataFrame, path: str, order: list[Column],
               single_file: bool = False) -> str:
    """Sorted header CSV export.  The sort is a distributed range sort, so the
    part files concatenate in order; ``single_file`` merges them (small marts).

    The export is written aside and then takes the place of an earlier one by a
    rename: if writing fails, the earlier one is still there.
    """
    spark = df.sparkSession
    out = df.orderBy(*order)
    if single_file:
        out = out.coalesce(1)
    aside = f"{path.rstrip('/')}.new-{uuid.uuid4().hex[:12]}"
    try:
        out.write.options(**CSV_WRITE).option("maxRecordsPerFile", ROWS_PER_FILE).csv(aside)
        files.publish(spark, aside, path)
    except Exception:
        files.delete(spark, aside)
        raise
    return path
