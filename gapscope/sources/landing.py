"""Readers for landed inputs.

* ``read_api_responses`` — census-style responses: a JSON array of arrays of
  strings whose first row is the header.  A document is a whole file, however
  it is wrapped into lines (or one line each with ``whole_files=False``), so
  many responses parse in parallel; a document is bounded by what one API
  call returns.  A document that does not parse, or has no header, fails the
  read with the file's name, or is left out and counted in the same pass;
  ``read_rejects`` names these.  Header codes are renamed, numeric cells coerced
  leniently, constants, run stamp and the penetration share added.
* ``read_open_csv`` — an optional CSV with whatever columns it has (all
  text, no inference pass), plus source and run stamp; absent → ``None``.
* ``latest_snapshot`` — lexicographically greatest complete ``<prefix>_*.csv``
  by *name*, from a one-level listing; nothing is read to decide.
* ``read_landed_csv`` — header CSV, columns found by name and cast.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import files
from ..functions.expr import coerce_double, share_pct
from .households import COUNT_COLUMNS, DATA_SOURCE

# ── fixed values: census variable codes and their column names ────────────────
CENSUS_VARIABLES = {
    "B28002_001E": "total_households",
    "B28002_002E": "households_with_internet",
    "B28002_004E": "households_broadband_any",
    "B28002_006E": "households_fiber_optic",
    "B28002_008E": "households_cable_dsl_satellite",
    "B28002_013E": "households_no_internet",
    "NAME": "geography_name",
}
OPEN_DATA_SOURCE = "FCC Form 477 Open Data"

_DOC = T.ArrayType(T.ArrayType(T.StringType()))


def landed_columns(geo_keys: list[str]) -> list[str]:
    return [*COUNT_COLUMNS, "geography_name", *geo_keys, "data_source",
            "geography_level", "ingested_at", "broadband_penetration_pct"]


def _documents(spark: SparkSession, path: str, whole_files: bool) -> tuple[DataFrame, Column, Column]:
    """(doc, file, begins) of every response document, its header, and what is wrong with it (null: nothing)."""
    text = spark.read.text(path, wholetext=whole_files).select("value", F.col("_metadata.file_path").alias("file"))
    if not whole_files:
        text = text.where(F.trim("value") != "")
    docs = text.select(F.from_json("value", _DOC).alias("doc"), "file", F.substring("value", 1, 80).alias("begins"))
    header = F.try_element_at("doc", F.lit(1))
    wrong = (F.when(F.col("doc").isNull(), "not an array of arrays")
             .when(F.coalesce(F.size(header), F.lit(0)) <= 0, "no header row"))
    return docs, header, wrong


def read_api_responses(spark: SparkSession, path: str, level: str, geo_keys: list[str],
                       ingested_at: str, whole_files: bool = True,
                       variables: dict[str, str] = CENSUS_VARIABLES,
                       data_source: str = DATA_SOURCE,
                       rejected: Observation | None = None) -> DataFrame:
    """Parse response documents into the landed relation for ``level``.

    Short rows are filled up with NULL, cells beyond the header are dropped, and
    columns that the header lacks are NULL.  With ``whole_files=False`` every
    line is a document (blank lines are none).  With ``rejected`` broken
    documents are left out, and counted there (``documents``) by the job that
    uses the rows.
    """
    if whole_files and rejected is None:
        for empty in empty_files(spark, path):   # a text scan passes over them
            raise ValueError(f"not a response document with a header row: {empty}")
    docs, header, wrong = _documents(spark, path, whole_files)
    if rejected is not None:
        docs = docs.observe(rejected, F.count_if(wrong.isNotNull()).alias("documents"))
        broken = F.lit(None)
    else:
        broken = F.raise_error(F.concat(F.lit("not a response document with a header row: "), "file"))
    # Row 0 is the header; every later row becomes one record keyed by it.
    # Header and body are split *before* the explode so each output row
    # carries only the small header, never the whole parsed document.
    body = F.when(wrong.isNull(), F.slice("doc", F.lit(2), F.size("doc")))
    parts = docs.select(header.alias("hdr"), body.otherwise(broken.cast(_DOC)).alias("body"))
    # explode_outer + a filter on the generated row: a plain explode makes the
    # optimizer add a size(body) > 0 filter that parses each document again
    rows = (parts.select("hdr", F.explode_outer("body").alias("row"))
            .filter(F.col("row").isNotNull()))
    by_name = {v: k for k, v in variables.items()}

    def field(name: str):
        at = F.array_position("hdr", F.lit(by_name.get(name, name)))
        return F.get("row", (at - 1).cast("int"))

    typed = rows.select(
        *[coerce_double(field(c)).alias(c) for c in COUNT_COLUMNS],
        field("geography_name").alias("geography_name"),
        *[field(k).alias(k) for k in geo_keys],
    )
    return typed.select(
        *COUNT_COLUMNS, "geography_name", *geo_keys,
        F.lit(data_source).alias("data_source"),
        F.lit(level).alias("geography_level"),
        F.lit(ingested_at).alias("ingested_at"),
        share_pct("households_broadband_any", "total_households").alias("broadband_penetration_pct"),
    )


def empty_files(spark: SparkSession, path: str) -> list[str]:
    """Response files without any bytes (from a listing; nothing is read)."""
    return [e.path for found in files.matching(spark, path)
            for e in (files.entries(spark, found.path) if found.folder else [found])
            if not e.folder and e.size == 0 and not e.name.startswith(("_", "."))]


def read_rejects(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """(document, begins, reason) of the response documents under ``path`` that are broken: the file, its or the line's
    first characters, and what is wrong."""
    docs, _, wrong = _documents(spark, path, whole_files)
    rejects = docs.select(F.col("file").alias("document"), "begins", wrong.alias("reason")).where("reason IS NOT NULL")
    if whole_files:
        empty = spark.createDataFrame([(f, "", "no bytes") for f in empty_files(spark, path)],   # names only: scans pass over them
                                      "document string, begins string, reason string")
        rejects = rejects.unionByName(empty)
    return rejects


def has_quoted_newlines(spark: SparkSession, path: str) -> bool:
    """Whether a record of the CSV files goes over several lines: its first line then has an odd number of quotes.
    Lines are read in splits, so this takes many tasks however large a file is."""
    odd = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    return not spark.read.text(path).where(odd % 2 == 1).isEmpty()


def read_open_csv(spark: SparkSession, path: str, ingested_at: str,
                  data_source: str = OPEN_DATA_SOURCE,
                  multiline: bool | None = None) -> DataFrame | None:
    """Optional open-data CSV: header row, any columns kept as text; absent → None.

    ``multiline`` allows quoted newlines inside cells and makes each file a
    single task; left open, it is turned on only if a cell of the files has one.
    """
    try:
        if multiline is None:
            multiline = has_quoted_newlines(spark, path)
        df = (spark.read.option("header", True).option("multiLine", multiline)
              .option("escape", '"').csv(path))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    return df.withColumns({"data_source": F.lit(data_source),
                           "ingested_at": F.lit(ingested_at)})


def latest_snapshot(spark: SparkSession, directory: str, prefix: str) -> str | None:
    """Path of the newest ``<prefix>_<run>.csv`` in ``directory`` by name (run ids sort by time).

    Only names are listed, one level deep.  A folder counts only with its
    ``_SUCCESS`` marker: a run that crashed while writing is not a snapshot.
    """
    return next((e.path for e in reversed(files.entries(spark, directory))
                 if e.name.startswith(f"{prefix}_") and e.name.endswith(".csv")
                 and (not e.folder or files.exists(spark, f"{e.path}/_SUCCESS"))), None)


def read_landed_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Header CSV with the columns of ``schema``, found by their names in the header and cast.

    Columns may come in any order and further ones are left out; a column that
    the header lacks, a file whose header differs from the first one's, and a
    cell that cannot be cast are errors.  Cells may hold quotes, commas, blanks
    and newlines: parallelism is by file, and ``land_csv`` bounds the rows of each.
    """
    wanted = spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema
    # a cell of nothing is null, one of two quotes is the empty text: no text may be read as null
    options = {"header": True, "escape": '"', "multiLine": True, "nullValue": "\u0000"}
    header = spark.read.options(**options).csv(path).columns
    missing = [f.name for f in wanted.fields if f.name not in header]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} in its header")
    text = T.StructType([T.StructField(c, T.StringType()) for c in header])
    rows = spark.read.options(**options, enforceSchema=False).schema(text).csv(path)
    return rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in wanted.fields])
