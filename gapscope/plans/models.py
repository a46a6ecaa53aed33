"""Staging relations and marts, as composable DataFrame → DataFrame functions.

* ``stage_state`` / ``stage_county`` — typed views over the raw relations:
  rename, half-even integer casts, drop rows without a positive total;
  sub-regions also get the ``is_underserved`` flag.
* ``mart_state`` — region summary with a global rank (histogram plan, see
  ``operators.rank``), fiber / no-internet shares and the access tier.
* ``mart_underserved`` — flagged sub-regions enriched with their region via
  a left join whose region side is broadcast behind a size bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import (ACCESS_TIER_ELSE, ACCESS_TIERS, SEVERITY_BANDS,
                              SEVERITY_ELSE, UNDERSERVED_RATIO, band, pct_of,
                              round_half_away)
from ..operators.join import enrich_left
from ..operators.rank import global_rank
from ..sources.households import COUNT_COLUMNS


def _rounded(c: str, kind: str) -> str:
    """SQL of ``cast_int``: the half-to-even cast of a double."""
    return f"CAST(RINT(CAST({c} AS DOUBLE)) AS {kind})"


# Staging is SQL text, so that the DataFrame functions and the catalog's views are
# the same statements.  Region counts are BIGINT where the reference has INTEGER: a
# region's totals pass 2^31 at the sizes this is made for.
VALID_TOTAL = f"total_households IS NOT NULL AND {_rounded('total_households', 'BIGINT')} > 0"
_TAIL = ["CAST(broadband_penetration_pct AS DOUBLE) AS broadband_penetration_pct",
         "data_source", "ingested_at", "loaded_at"]
STAGE_STATE = ["geography_name AS state_name", "state AS state_fips",
               *[f"{_rounded(c, 'BIGINT')} AS {c}" for c in COUNT_COLUMNS], *_TAIL]


def _underserved(no_internet: str, total: str, ratio: float) -> str:
    share = f"{_rounded(no_internet, 'INT')} * 1.0D / NULLIF({_rounded(total, 'INT')}, 0)"
    return f"COALESCE({share} > {ratio}D, FALSE)"


STAGE_COUNTY = ["geography_name AS county_name", "county AS county_fips", "state AS state_fips",
                *[f"{_rounded(c, 'INT')} AS {c}" for c in COUNT_COLUMNS], _TAIL[0],
                f"{_underserved('households_no_internet', 'total_households', UNDERSERVED_RATIO)} AS is_underserved",
                *_TAIL[1:]]


def valid_total(raw: DataFrame) -> DataFrame:
    """Rows with a present, positive total (after the integer cast)."""
    return raw.where(VALID_TOTAL)


def stage_state(raw_state: DataFrame) -> DataFrame:
    return valid_total(raw_state).selectExpr(*STAGE_STATE)


def stage_county(raw_county: DataFrame) -> DataFrame:
    return valid_total(raw_county).selectExpr(*STAGE_COUNTY)


def staging_query(columns: list[str], table: str) -> str:
    """The same staging over a catalog table, as the query of a view."""
    return f"SELECT {', '.join(columns)} FROM {table} WHERE {VALID_TOTAL}"


def underserved_flag(no_internet: str, total: str, ratio: float = UNDERSERVED_RATIO) -> F.Column:
    """no_internet share strictly above ``ratio``; a NULL share is FALSE."""
    return F.expr(_underserved(no_internet, total, ratio))


def access_tier(pct) -> F.Column:
    return band(pct, ACCESS_TIERS, ACCESS_TIER_ELSE)


def severity(pct) -> F.Column:
    return band(pct, SEVERITY_BANDS, SEVERITY_ELSE)


def mart_state(stg_state: DataFrame, state_bound: int | None = None) -> DataFrame:
    """``state_bound``: proven upper bound on the number of regions, if known."""
    ranked = global_rank(stg_state, "broadband_penetration_pct", ascending=False,
                         rank_col="broadband_rank", key_bound=state_bound)
    return ranked.select(
        "state_name", "state_fips", *COUNT_COLUMNS, "broadband_penetration_pct",
        "broadband_rank",
        pct_of("households_fiber_optic", "total_households").alias("fiber_penetration_pct"),
        pct_of("households_no_internet", "total_households").alias("no_internet_pct"),
        access_tier("broadband_penetration_pct").alias("access_tier"),
        "data_source", "loaded_at",
    )


def state_lookup(stg_state: DataFrame) -> DataFrame:
    return stg_state.select("state_fips", "state_name",
                            F.col("broadband_penetration_pct").alias("state_broadband_pct"))


def with_state(stg_county: DataFrame, stg_state: DataFrame,
               state_bound: int | None = None) -> DataFrame:
    """Every staged sub-region with its region's name and penetration (left join)."""
    return enrich_left(stg_county, state_lookup(stg_state), "state_fips", state_bound)


def gap_to_state(county_pct="broadband_penetration_pct", state_pct="state_broadband_pct"):
    return round_half_away(F.col(state_pct) - F.col(county_pct))


def mart_underserved(stg_county: DataFrame, stg_state: DataFrame,
                     state_bound: int | None = None) -> DataFrame:
    flagged = stg_county.filter(F.col("is_underserved"))
    joined = with_state(flagged, stg_state, state_bound)
    return joined.select(
        "county_name", "county_fips", "state_fips", "state_name",
        "total_households", "households_broadband_any", "households_no_internet",
        F.col("broadband_penetration_pct").alias("county_broadband_pct"),
        "state_broadband_pct",
        gap_to_state().alias("pct_below_state_avg"),
        pct_of("households_no_internet", "total_households").alias("no_internet_pct"),
        "is_underserved",
        severity("broadband_penetration_pct").alias("underserved_severity"),
        "loaded_at",
    )
