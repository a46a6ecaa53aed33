"""The layered warehouse over one data directory: raw → staging → marts.

``Warehouse(spark, sf_dir)`` derives the raw relations from the test tables
and *loads* them: a full-refresh parquet write under the shared checkpoint
folder (so lineage back to ``lineitem`` is cut and an executor loss replays
from the written table, not from the source join).  Staging is lazy (a view
in the reference); the region staging relation is bounded by the nation
dimension and is reused by both marts, so it is written once as a table.  Marts
are lazy unless ``build_marts()`` writes them as tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..session import current_lease, fresh_dir, materialize, run_concurrently, under
from ..sources.households import (DEFAULT_INGESTED_AT, DEFAULT_LOADED_AT, RULES,
                                  DerivationRules, raw_relations)
from ..sources.tables import row_count
from . import analytics, models

# fixed values: the marts' names
MART_TABLES = ("mart_state_broadband_summary", "mart_underserved_counties")


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str, root: str | None = None,
                 rules: DerivationRules = RULES,
                 ingested_at: str = DEFAULT_INGESTED_AT,
                 loaded_at: str = DEFAULT_LOADED_AT):
        self.spark = spark
        self.sf_dir = sf_dir
        self.root = root or fresh_dir(spark, "warehouse")
        self.rules = rules
        self.ingested_at = ingested_at
        self.loaded_at = loaded_at
        self._lease = current_lease()   # of whoever made the warehouse, also for what it writes later
        self._loaded = False
        self._marts_built = False

    # ── raw layer ──────────────────────────────────────────────────────────
    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def derived_raw(self, materialize: bool = False) -> tuple[DataFrame, DataFrame]:
        counts_path = self.path("work", "customer_counts") if materialize else None
        return raw_relations(self.spark, self.sf_dir, self.rules,
                             self.ingested_at, self.loaded_at, counts_path)

    def load(self) -> "Warehouse":
        """Full refresh of both raw tables (overwrite)."""
        if not self._loaded:
            state, county = self.derived_raw(materialize=True)
            run_concurrently(
                lambda: state.write.mode("overwrite").parquet(self.path("raw", "census_state")),
                lambda: county.write.mode("overwrite").parquet(self.path("raw", "census_county")))
            self._loaded = True
        return self

    def raw_state(self) -> DataFrame:
        return self.load().spark.read.parquet(self.path("raw", "census_state"))

    def raw_county(self) -> DataFrame:
        return self.load().spark.read.parquet(self.path("raw", "census_county"))

    # ── staging ─────────────────────────────────────────────────────────────
    @cached_property
    def state_bound(self) -> int:
        """Regions come from nation keys, so the nation count bounds them."""
        return row_count(self.spark, self.sf_dir, "nation")

    @cached_property
    def _stg_state(self) -> DataFrame:
        with under(self._lease):
            return materialize(models.stage_state(self.raw_state()), "stg-state")

    def stg_state(self) -> DataFrame:
        return self._stg_state

    def stg_county(self) -> DataFrame:
        return models.stage_county(self.raw_county())

    # ── marts ───────────────────────────────────────────────────────────────
    def mart_state_lazy(self) -> DataFrame:
        return models.mart_state(self.stg_state(), self.state_bound)

    def mart_underserved_lazy(self) -> DataFrame:
        return models.mart_underserved(self.stg_county(), self.stg_state(), self.state_bound)

    def build_marts(self) -> "Warehouse":
        if not self._marts_built:
            self.stg_state()   # shared by both marts: written once, before either starts
            self.state_bound   # likewise resolved once, not raced by the two threads
            run_concurrently(
                lambda: self.mart_state_lazy().write.mode("overwrite").parquet(
                    self.path("marts", MART_TABLES[0])),
                self._build_underserved)
            self._marts_built = True
        return self

    def mart_state(self) -> DataFrame:
        if self._marts_built:
            return self.spark.read.parquet(self.path("marts", MART_TABLES[0]))
        return self.mart_state_lazy()

    def mart_underserved(self) -> DataFrame:
        if self._marts_built:
            return self.spark.read.parquet(self.path("marts", MART_TABLES[1]))
        return self.mart_underserved_lazy()

    def _build_underserved(self) -> None:
        mart, summary = self.path("marts", MART_TABLES[1]), self.path("marts", "underserved_by_region")
        self.mart_underserved_lazy().write.mode("overwrite").parquet(mart)
        analytics.region_summary(self.spark.read.parquet(mart)).coalesce(1).write.mode("overwrite").parquet(summary)   # a row per region

    def region_summary(self) -> DataFrame:
        """The underserved mart's aggregates by region: one scan, then shared by all that reports them."""
        return self.build_marts().spark.read.parquet(self.path("marts", "underserved_by_region"))
