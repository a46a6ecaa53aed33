"""Data-quality operators: per-column null profile and the post-load check suite.

Both are single distributed aggregations; nothing but counts is collected.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import avg_rounded, round_half_even


def _is_missing(df: DataFrame, name: str):
    c = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)   # pandas counts NaN as missing too
    return c.isNull()


def null_profile(df: DataFrame, threshold: float = 50.0, digits: int = 1) -> DataFrame:
    """One row per column: null share in percent, whether it exceeds ``threshold``,
    and the frame's shape (rows × columns).

    One aggregation pass computes every column's null count; ``unpivot``
    turns the single wide row into the long profile.  An empty frame gives
    NULL shares, which are never flagged.
    """
    cols = df.columns
    return _profile(df.agg(*_null_counts(df)), cols, threshold, digits)


def _null_counts(df: DataFrame) -> list[F.Column]:
    return [F.count(F.lit(1)).alias("__rows"),
            *[F.count_if(_is_missing(df, c)).alias(f"__n{i}") for i, c in enumerate(df.columns)]]


def _profile(wide: DataFrame, cols: list[str], threshold: float, digits: int) -> DataFrame:
    long = wide.unpivot("__rows", [F.col(f"__n{i}").alias(c) for i, c in enumerate(cols)],
                        "column_name", "null_count")
    pct = round_half_even(F.col("null_count") / F.nullif(F.col("__rows"), F.lit(0)) * 100.0, digits)
    return long.select(
        "column_name",
        pct.alias("null_pct"),
        F.coalesce(pct > threshold, F.lit(False)).alias("high_null"),
        F.col("__rows").alias("n_rows"),
        F.lit(len(cols)).alias("n_columns"),
    )


class Profiled:
    """``df`` that is profiled while it is written: write ``rows``, then ask for ``n_rows`` and ``profile``.

    The counts come from the write itself (a task that is tried again counts once),
    so the data is not read a second time.
    """

    def __init__(self, df: DataFrame):
        self._seen, self._spark, self.columns = Observation(), df.sparkSession, df.columns
        self.rows = df.observe(self._seen, *_null_counts(df))

    @property
    def n_rows(self) -> int:
        return int(self._seen.get.get("__rows", 0))

    def profile(self, threshold: float = 50.0, digits: int = 1) -> DataFrame:
        """``null_profile`` of what was written."""
        names = ["__rows", *[f"__n{i}" for i in range(len(self.columns))]]
        found = self._seen.get
        wide = self._spark.createDataFrame([tuple(int(found.get(n, 0)) for n in names)], ", ".join(f"`{n}` long" for n in names))
        return _profile(wide, self.columns, threshold, digits)


# ── fixed values: labels of the post-load checks ──────────────────────────────
CHECK_STATE_COUNT = "State count"
CHECK_COUNTY_COUNT = "County count"
CHECK_TOP5 = "Top 5 states by broadband penetration"
CHECK_BOTTOM5 = "Bottom 5 states by broadband penetration"
CHECK_OFFLINE = "Counties with zero internet access"
CHECK_AVG = "National broadband penetration average"


def _labelled(df: DataFrame, check: str, item, value) -> DataFrame:
    return df.select(F.lit(check).alias("check"), item.cast("string").alias("item"),
                     value.cast("double").alias("value"))


def top_states(raw_state: DataFrame, k: int = 5, ascending: bool = False) -> DataFrame:
    pct = F.col("broadband_penetration_pct")
    return (raw_state.filter(pct.isNotNull())
            .select("geography_name", "broadband_penetration_pct")
            .orderBy(pct.asc() if ascending else pct.desc(), "geography_name").limit(k))


def _scalar_checks(df: DataFrame, checks: list[tuple[str, str, F.Column]]) -> DataFrame:
    """Several scalar checks over one table in a single aggregation pass,
    unpivoted into labelled (check, item, value) rows."""
    wide = df.agg(*[value.cast("double").alias(f"__c{i}") for i, (_, _, value) in enumerate(checks)])
    stacked = wide.unpivot([], [F.col(f"__c{i}").alias(str(i)) for i in range(len(checks))],
                           "__i", "value")
    labels = F.create_map(*[x for i, (check, _, _) in enumerate(checks)
                            for x in (F.lit(str(i)), F.lit(check))])
    items = F.create_map(*[x for i, (_, item, _) in enumerate(checks)
                           for x in (F.lit(str(i)), F.lit(item))])
    return stacked.select(labels[F.col("__i")].alias("check"), items[F.col("__i")].alias("item"),
                          "value")


Part = tuple[list[str], Callable[[], DataFrame]]   # labels of checks, and the query that gives their rows


def _check_parts(raw_state: DataFrame, raw_county: DataFrame, offline_share: float, alone: bool) -> list[Part]:
    """The checks as queries: each table's scalar checks share one scan, or every check is ``alone``."""
    pct = F.col("broadband_penetration_pct")
    state_checks = [
        (CHECK_STATE_COUNT, "count", F.count(F.lit(1))),
        (CHECK_AVG, "avg_pct", avg_rounded(pct)),          # AVG skips NULL shares
    ]
    county_checks = [
        (CHECK_COUNTY_COUNT, "count", F.count(F.lit(1))),
        (CHECK_OFFLINE, "county_count",
         F.count_if(F.col("households_no_internet") > F.col("total_households") * offline_share)),
    ]
    parts: list[Part] = []
    for table, checks in ((raw_state, state_checks), (raw_county, county_checks)):
        for some in ([[c] for c in checks] if alone else [checks]):
            parts.append(([c[0] for c in some], lambda t=table, some=some: _scalar_checks(t, some)))
    for check, ascending in ((CHECK_TOP5, False), (CHECK_BOTTOM5, True)):
        parts.append(([check], lambda c=check, up=ascending: _labelled(
            top_states(raw_state, ascending=up), c, F.col("geography_name"), pct)))
    return parts


def check_suite(raw_state: DataFrame, raw_county: DataFrame,
                offline_share: float = 0.5) -> DataFrame:
    """The six post-load checks as one long frame (check, item, value).

    Each table's scalar checks share one scan; the two top-5 lists are
    top-k queries (no full sort).  A check that cannot be planned (a table
    lacks its column) gives one row with the error as its item and no value;
    the others give their results.  An error while the rows are computed fails
    the frame: ``run_checks`` isolates these too.
    """
    spark = raw_state.sparkSession
    alone = {labels[0]: make for labels, make in _check_parts(raw_state, raw_county, offline_share, alone=True)}
    parts = []
    for labels, make in _check_parts(raw_state, raw_county, offline_share, alone=False):
        try:
            parts.append(make())
        except AnalysisException:
            for label in labels:
                try:
                    parts.append(alone[label]())
                except AnalysisException as e:
                    parts.append(_failed_check(spark, label, e))
    return reduce(DataFrame.unionByName, parts)


def run_checks(raw_state: DataFrame, raw_county: DataFrame, folder: str, offline_share: float = 0.5) -> DataFrame:
    """``check_suite``, computed and written as Parquet under ``folder``, with every check's failure kept to itself.

    All checks run as one job that shares scans.  Only if that fails does each run
    as a job of its own: one that fails (a cell that cannot be read, a lost file)
    gives a row with the error as its item and no value, the others their results.
    """
    spark = raw_state.sparkSession
    try:
        check_suite(raw_state, raw_county, offline_share).coalesce(1).write.parquet(folder)
    except Exception:  # noqa: BLE001 - told apart check by check
        for (label,), make in _check_parts(raw_state, raw_county, offline_share, alone=True):
            try:
                make().coalesce(1).write.mode("append").parquet(folder)
            except Exception as e:  # noqa: BLE001 - becomes the check's row
                _failed_check(spark, label, e).coalesce(1).write.mode("append").parquet(folder)
    return spark.read.schema("check string, item string, value double").parquet(folder)


def reason(e: BaseException) -> str:
    """An error in a line: its condition, if Spark names one, else its kind and first line."""
    named = e.getCondition() if isinstance(e, PySparkException) else None
    return named or f"{type(e).__name__}: {(str(e).splitlines() or [''])[0]}"[:200]


def _failed_check(spark, label: str, e: BaseException) -> DataFrame:
    return spark.createDataFrame([(label, f"error: {reason(e)}", None)], "check string, item string, value double")


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for each named relation — one aggregate each."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def describe(spark, tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, ordinal, column_name, data_type) from each relation's schema."""
    rows = [(name, i + 1, f.name, f.dataType.simpleString())
            for name, df in tables.items() for i, f in enumerate(df.schema.fields)]
    schema = "table_name string, ordinal int, column_name string, data_type string"
    return spark.createDataFrame(rows, schema)
