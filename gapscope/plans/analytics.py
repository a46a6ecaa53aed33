"""Analytical queries over the two marts, plus the post-transform previews.

Every ORDER BY ... LIMIT gets the natural key as a tie-breaker so the
top-k is deterministic; Catalyst plans each as TakeOrderedAndProject
(per-partition top-k, then a k-row merge) rather than a full sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import (FIBER_EDGE, GAP_WEIGHT, NO_INTERNET_WEIGHT, SEVERITY_BANDS, SEVERITY_ELSE, avg_rounded,
                              cast_int, nullif_zero, round_half_away)
from ..operators.rank import global_rank


SEVERITIES = (*(label for _, _, label in SEVERITY_BANDS), SEVERITY_ELSE)


def _avg2(c: str) -> F.Column:
    return avg_rounded(c)


def q1_scorecard(mart_state: DataFrame) -> DataFrame:
    tier = F.col("access_tier")
    return mart_state.agg(
        F.count(F.lit(1)).alias("total_states"),
        _avg2("broadband_penetration_pct").alias("avg_broadband_pct"),
        round_half_away(F.min("broadband_penetration_pct")).alias("min_broadband_pct"),
        round_half_away(F.max("broadband_penetration_pct")).alias("max_broadband_pct"),
        _avg2("fiber_penetration_pct").alias("avg_fiber_pct"),
        _avg2("no_internet_pct").alias("avg_no_internet_pct"),
        F.count_if(tier == "High Access").alias("high_access_states"),
        F.count_if(tier == "Medium Access").alias("medium_access_states"),
        F.count_if(tier == "Low Access").alias("low_access_states"),
        F.count_if(tier == "Critical Gap").alias("critical_gap_states"),
    )


def q2_ranking(mart_state: DataFrame) -> DataFrame:
    return (mart_state.select(
        F.col("broadband_rank").alias("rank"), "state_name",
        F.col("broadband_penetration_pct").alias("broadband_pct"),
        F.col("fiber_penetration_pct").alias("fiber_pct"),
        "no_internet_pct", "access_tier")
        .orderBy("rank", "state_name"))


def q3_fiber(mart_state: DataFrame, edge: int = FIBER_EDGE,
             state_bound: int | None = None) -> DataFrame:
    base = (mart_state.filter(F.col("fiber_penetration_pct").isNotNull())
            .select("state_name", "fiber_penetration_pct", "broadband_penetration_pct"))
    ranked = global_rank(base, "fiber_penetration_pct", ascending=False, rank_col="fiber_rank",
                         key_bound=state_bound)
    n_ranked = base.agg(F.count(F.lit(1))).scalar()  # uncorrelated scalar subquery
    r = F.col("fiber_rank")
    category = (F.when(r <= edge, "Fiber Leader")
                .when(r > n_ranked - edge, "Fiber Laggard")
                .otherwise("Mid Tier"))
    return (ranked.select("fiber_rank", "state_name", "fiber_penetration_pct",
                          "broadband_penetration_pct", category.alias("fiber_category"))
            .orderBy("fiber_rank", "state_name"))


def region_summary(mart_u: DataFrame) -> DataFrame:
    """All that is counted, averaged or summed of the underserved sub-regions by region, in one scan: a row per region."""
    sev = F.col("underserved_severity")
    return mart_u.groupBy("state_name").agg(
        F.count(F.lit(1)).alias("rows"), F.count("county_name").alias("named"),
        _avg2("county_broadband_pct").alias("avg_county_broadband_pct"),
        _avg2("no_internet_pct").alias("avg_no_internet_pct"),
        F.sum("total_households").alias("households"), F.sum("households_broadband_any").alias("connected"),
        *[F.count_if(sev == label).alias(label) for label in SEVERITIES])


def q4_of(summary: DataFrame, k: int = 20) -> DataFrame:
    return (summary.select(
        "state_name", F.col("rows").alias("underserved_county_count"), "avg_county_broadband_pct", "avg_no_internet_pct",
        F.col("Critical").alias("critical_counties"), F.col("Severe").alias("severe_counties"))
        .orderBy(F.col("underserved_county_count").desc(), F.col("state_name").asc_nulls_last())
        .limit(k))


def q4_by_state(mart_u: DataFrame, k: int = 20) -> DataFrame:
    return q4_of(region_summary(mart_u), k)


def q5_critical(mart_u: DataFrame) -> DataFrame:
    without = cast_int(F.col("total_households") * (1 - F.col("county_broadband_pct") / 100.0))
    return (mart_u.filter(F.col("underserved_severity") == "Critical")
            .select("county_name", "state_name", "county_broadband_pct", "no_internet_pct",
                    "pct_below_state_avg", "total_households",
                    without.alias("households_without_broadband"))
            .orderBy(F.col("county_broadband_pct").asc_nulls_last(), "county_name"))


def gap_index(gap="pct_below_state_avg", offline="no_internet_pct") -> F.Column:
    return round_half_away(F.col(gap) * GAP_WEIGHT + F.col(offline) * NO_INTERNET_WEIGHT)


def q6_gap_index(mart_u: DataFrame, k: int = 25) -> DataFrame:
    # ties beyond the name are settled by the natural key, which the result does not show
    return (mart_u.withColumn("broadband_gap_index", gap_index())
            .orderBy(F.col("broadband_gap_index").desc_nulls_last(), "county_name", "state_fips", "county_fips")
            .limit(k)
            .select("county_name", "state_name", "county_broadband_pct", "state_broadband_pct",
                    "pct_below_state_avg", "no_internet_pct", "total_households",
                    "broadband_gap_index", "underserved_severity"))


def q7_of(summary: DataFrame, k: int = 15) -> DataFrame:
    tot, bb = F.col("households"), F.col("connected")
    return (summary.select(
        "state_name", F.col("named").alias("underserved_counties"),
        tot.alias("total_households_in_underserved"),
        bb.alias("households_with_broadband"),
        (tot - bb).alias("households_without_broadband"),
        round_half_away((tot - bb) * 100.0 / nullif_zero(tot)).alias("pct_without_broadband"))
        .orderBy(F.col("households_without_broadband").desc_nulls_last(),
                 F.col("state_name").asc_nulls_last())
        .limit(k))


def q7_impact(mart_u: DataFrame, k: int = 15) -> DataFrame:
    return q7_of(region_summary(mart_u), k)


def q8_tiers(mart_state: DataFrame) -> DataFrame:
    members = F.expr("listagg(state_name, ', ') WITHIN GROUP "
                     "(ORDER BY broadband_penetration_pct DESC NULLS LAST, state_name)")
    return (mart_state.groupBy("access_tier").agg(
        F.count(F.lit(1)).alias("state_count"),
        _avg2("broadband_penetration_pct").alias("avg_penetration"),
        members.alias("states"))
        .orderBy(F.col("avg_penetration").desc_nulls_last(), "access_tier"))


# ── previews (post-transform) ─────────────────────────────────────────────────

def preview_states(mart_state: DataFrame, k: int = 10) -> DataFrame:
    return (mart_state.select("state_name", "broadband_penetration_pct",
                              "broadband_rank", "access_tier")
            .orderBy("broadband_rank", "state_name").limit(k))


def preview_counties(mart_u: DataFrame, k: int = 10) -> DataFrame:
    return (mart_u.orderBy(F.col("county_broadband_pct").asc_nulls_last(), "county_name", "state_fips", "county_fips")
            .limit(k)
            .select("county_name", "state_name", "county_broadband_pct", "underserved_severity"))


def severity_of(summary: DataFrame) -> DataFrame:
    counts = summary.agg(*[F.sum(label).alias(label) for label in SEVERITIES])
    return (counts.unpivot([], list(SEVERITIES), "underserved_severity", "county_count").where("county_count > 0")
            .orderBy(F.col("county_count").desc(), "underserved_severity"))


def severity_counts(mart_u: DataFrame) -> DataFrame:
    return severity_of(region_summary(mart_u))
