"""Raw region / sub-region relations derived from the star-schema test tables.

The engine's inputs are household-internet counts at two geographic levels.
The test tables carry none, so they are derived (region ≈ nation,
sub-region ≈ customer, household ≈ lineitem row) as a Spark job whose work
grows with ``lineitem``:

1. ``orders ⋈ customer`` on the customer key gives each order its owner's
   nation (both sides shuffle on the customer key);
2. ``lineitem ⋈ owners`` on the order key (the only lineitem-sized shuffle);
3. conditional counts grouped by customer — partial aggregation runs
   map-side, so a customer owning a third of all lines still ships one
   partial row per map task;
4. ``customer ⋈ broadcast(nation)`` (nation size checked from its footer)
   left-joined to the counts, which are already hash-partitioned on the
   customer key, so only ``customer`` moves;
5. the region relation is the same per-customer counts summed by nation —
   a group-by over the (written) per-customer table, one row per nation.

Planted nulls / zero totals / a missing region follow FIXTURES.md.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import share_pct
from ..operators.join import bounded_broadcast
from .tables import read_table, row_count

COUNT_COLUMNS = [
    "total_households",
    "households_with_internet",
    "households_broadband_any",
    "households_fiber_optic",
    "households_cable_dsl_satellite",
    "households_no_internet",
]

# ── fixed values: constants of the landed census relations ────────────────────
DATA_SOURCE = "Census ACS 5-Year 2022"
LEVEL_STATE = "state"
LEVEL_COUNTY = "county"
# run stamps are parameters; these defaults keep repeated runs hash-equal
DEFAULT_INGESTED_AT = "2024-01-01T00:00:00"
DEFAULT_LOADED_AT = "2024-01-01T00:05:00"


@dataclass(frozen=True)
class DerivationRules:
    """How test-table rows become household counts (FIXTURES.md §2)."""
    base: int = 37              # b = base + nationkey % spread
    spread: int = 10
    internet_margin: int = 2    # with_internet: q <= b + 2
    fiber_margin: int = 25      # fiber: q <= b - 25; cable/dsl: b - 25 < q <= b
    offline_discount: float = 0.085  # no_internet: discount >= 0.085
    # planted cases, region level
    dropped_region: int = 24
    null_broadband_region: int = 13
    null_fiber_region: int = 17
    # planted cases, sub-region level (custkey modulus)
    null_broadband_mod: int = 97
    null_offline_mod: int = 89
    null_total_mod: int = 103
    zero_total_mod: int = 101


RULES = DerivationRules()


def customer_counts(spark: SparkSession, sf_dir: str,
                    rules: DerivationRules = RULES) -> DataFrame:
    """Per-customer household counts (unplanted), incl. customers with no lines.

    Columns: c_custkey, c_name, c_nationkey, n_name, six double counts.
    """
    lines = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_quantity", "l_discount")
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    owners = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")

    # Neither side of the two fact joins has a size bound, so both are
    # shuffle sort-merge joins (never a broadcast chosen from a file-size
    # estimate); AQE splits a skewed partition (a hot order or customer).
    order_owner = (orders.hint("merge").join(owners, orders.o_custkey == owners.c_custkey)
                   .select("o_orderkey", "c_custkey", "c_nationkey"))
    hh = lines.hint("merge").join(order_owner, lines.l_orderkey == order_owner.o_orderkey)

    q = F.col("l_quantity")
    b = F.lit(rules.base) + F.col("c_nationkey") % rules.spread
    counts = hh.groupBy("c_custkey").agg(
        F.count(q).alias("total_households"),
        F.count_if(q <= b + rules.internet_margin).alias("households_with_internet"),
        F.count_if(q <= b).alias("households_broadband_any"),
        F.count_if(q <= b - rules.fiber_margin).alias("households_fiber_optic"),
        F.count_if((q > b - rules.fiber_margin) & (q <= b)).alias("households_cable_dsl_satellite"),
        F.count_if(F.col("l_discount") >= rules.offline_discount).alias("households_no_internet"),
    )

    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    nation = bounded_broadcast(nation, row_count(spark, sf_dir, "nation"))
    customers = (read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey")
                 .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
                 .drop("n_nationkey"))
    return (customers.join(counts, "c_custkey", "left")
            .select("c_custkey", "c_name", "c_nationkey", "n_name",
                    *[F.coalesce(F.col(c), F.lit(0)).cast("double").alias(c)
                      for c in COUNT_COLUMNS]))


def _null_when(cond: Column, name: str) -> Column:
    return F.when(~cond, F.col(name))


def _finish_raw(df: DataFrame, level: str, ingested_at: str, loaded_at: str,
                keys: list[str]) -> DataFrame:
    """Landing-time columns: constants, run stamps and the penetration share."""
    return df.select(
        *COUNT_COLUMNS, "geography_name", *keys,
        F.lit(DATA_SOURCE).alias("data_source"),
        F.lit(level).alias("geography_level"),
        F.lit(ingested_at).alias("ingested_at"),
        share_pct("households_broadband_any", "total_households").alias("broadband_penetration_pct"),
        F.lit(loaded_at).alias("loaded_at"),
    )


def raw_county(counts: DataFrame, rules: DerivationRules = RULES,
               ingested_at: str = DEFAULT_INGESTED_AT,
               loaded_at: str = DEFAULT_LOADED_AT) -> DataFrame:
    """Sub-region relation as landed and loaded (``raw.census_county`` shape)."""
    k = F.col("c_custkey")
    total = (F.when(k % rules.null_total_mod == 0, F.lit(None).cast("double"))
             .when(k % rules.zero_total_mod == 0, F.lit(0.0))
             .otherwise(F.col("total_households")))
    planted = counts.select(
        total.alias("total_households"),
        "households_with_internet",
        _null_when(k % rules.null_broadband_mod == 0, "households_broadband_any")
        .alias("households_broadband_any"),
        "households_fiber_optic",
        "households_cable_dsl_satellite",
        _null_when(k % rules.null_offline_mod == 0, "households_no_internet")
        .alias("households_no_internet"),
        F.concat("c_name", F.lit(", "), "n_name").alias("geography_name"),
        F.col("c_nationkey").cast("string").alias("state"),
        k.cast("string").alias("county"),
    )
    return _finish_raw(planted, LEVEL_COUNTY, ingested_at, loaded_at, ["state", "county"])


def raw_state(counts: DataFrame, rules: DerivationRules = RULES,
              ingested_at: str = DEFAULT_INGESTED_AT,
              loaded_at: str = DEFAULT_LOADED_AT) -> DataFrame:
    """Region relation (``raw.census_state`` shape): counts summed by nation."""
    sums = (counts.groupBy("c_nationkey", "n_name")
            .agg(*[F.sum(c).alias(c) for c in COUNT_COLUMNS])
            .filter(F.col("c_nationkey") != rules.dropped_region))
    k = F.col("c_nationkey")
    planted = sums.select(
        "total_households",
        "households_with_internet",
        _null_when(k == rules.null_broadband_region, "households_broadband_any")
        .alias("households_broadband_any"),
        _null_when(k == rules.null_fiber_region, "households_fiber_optic")
        .alias("households_fiber_optic"),
        "households_cable_dsl_satellite",
        "households_no_internet",
        F.col("n_name").alias("geography_name"),
        k.cast("string").alias("state"),
    )
    return _finish_raw(planted, LEVEL_STATE, ingested_at, loaded_at, ["state"])


def written_counts(spark: SparkSession, sf_dir: str, path: str,
                   rules: DerivationRules = RULES) -> DataFrame:
    """Per-customer counts written once as a table, then read back.

    Both raw relations derive from it, so the lineitem-sized join and
    aggregation run once, and a lost executor replays from this table.
    """
    customer_counts(spark, sf_dir, rules).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def raw_relations(spark: SparkSession, sf_dir: str, rules: DerivationRules = RULES,
                  ingested_at: str = DEFAULT_INGESTED_AT,
                  loaded_at: str = DEFAULT_LOADED_AT,
                  counts_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(raw_state, raw_county) over the test tables.

    With ``counts_path`` the shared per-customer counts are written there
    first (one lineitem pass for both); without it both stay lazy.
    """
    counts = (written_counts(spark, sf_dir, counts_path, rules) if counts_path
              else customer_counts(spark, sf_dir, rules))
    return (raw_state(counts, rules, ingested_at, loaded_at),
            raw_county(counts, rules, ingested_at, loaded_at))
