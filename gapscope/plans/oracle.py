"""DuckDB SQL for every registered query (the correctness oracle).

Each statement derives the raw relations from the base tables (``customer
nation orders lineitem``, by FIXTURES.md) and builds the layers from the
*definitions* of their columns: a rank is one more than the number of strictly
greater values, a tier is the interval a value falls in, a flag compares two
counts.  All literals are written out here; nothing is imported from the engine.
"""

from __future__ import annotations

_COUNTS = ("total_households households_with_internet households_broadband_any "
           "households_fiber_optic households_cable_dsl_satellite households_no_internet").split()
STAMP = "2024-01-01T00:00:00"
LOADED = "2024-01-01T00:05:00"
SOURCE = "Census ACS 5-Year 2022"


def _cast(kind: str) -> str:
    return ", ".join(f"CAST({c} AS {kind}) AS {c}" for c in _COUNTS)


FACT_CTES = f"""
cust AS (
    SELECT c_custkey, c_name, c_nationkey, n_name, 37 + c_nationkey % 10 AS b
    FROM customer JOIN nation ON c_nationkey = n_nationkey
),
hits AS (
    SELECT o_custkey AS k, l_quantity - b AS beyond, l_discount AS d, l_quantity AS q
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN cust ON o_custkey = c_custkey
),
tallies AS (
    SELECT k, COUNT(q) AS t, COUNT(*) FILTER (beyond <= 2) AS i, COUNT(*) FILTER (beyond <= 0) AS bb,
        COUNT(*) FILTER (beyond <= -25) AS f, COUNT(*) FILTER (beyond > -25 AND beyond <= 0) AS cd,
        COUNT(*) FILTER (d >= 0.085) AS n
    FROM hits GROUP BY k
),
cust_counts AS (
    SELECT cust.*, {", ".join(f"CAST(COALESCE({a}, 0) AS DOUBLE) AS {c}"
                              for a, c in zip(("t", "i", "bb", "f", "cd", "n"), _COUNTS))}
    FROM cust LEFT JOIN tallies ON k = c_custkey
),
county_facts AS (
    SELECT * REPLACE (CASE WHEN c_custkey % 103 <> 0 THEN IF(c_custkey % 101 = 0, 0, total_households) END AS total_households,
                      CASE WHEN c_custkey % 97 <> 0 THEN households_broadband_any END AS households_broadband_any,
                      CASE WHEN c_custkey % 89 <> 0 THEN households_no_internet END AS households_no_internet)
    FROM cust_counts
),
state_sums AS (
    SELECT c_nationkey, n_name, {", ".join(f"SUM({c}) AS {c}" for c in _COUNTS)}
    FROM cust_counts WHERE c_nationkey <> 24 GROUP BY ALL
),
state_facts AS (
    SELECT * REPLACE (CASE WHEN c_nationkey <> 13 THEN households_broadband_any END AS households_broadband_any,
                      CASE WHEN c_nationkey <> 17 THEN households_fiber_optic END AS households_fiber_optic)
    FROM state_sums
),"""


def _landed(name: str, facts: str, label: str, keys: str, level: str) -> str:
    return f"""
{name} AS (
    SELECT {", ".join(_COUNTS)}, {label} AS geography_name, {keys},
        '{SOURCE}' AS data_source, '{level}' AS geography_level, '{STAMP}' AS ingested_at,
        round_even(households_broadband_any / NULLIF(total_households, 0) * 100, 2) AS broadband_penetration_pct,
        '{LOADED}' AS loaded_at
    FROM {facts}
)"""


RAW_CTES = FACT_CTES + _landed(
    "raw_county", "county_facts", "c_name || ', ' || n_name",
    "CAST(c_nationkey AS VARCHAR) AS state, CAST(c_custkey AS VARCHAR) AS county", "county") + "," + _landed(
    "raw_state", "state_facts", "n_name", "CAST(c_nationkey AS VARCHAR) AS state", "state")

# region counts are BIGINT (a deliberate widening, see README), sub-region counts INTEGER
STAGING_CTES = f"""
typed_state AS (SELECT * EXCLUDE ({", ".join(_COUNTS)}), {_cast("BIGINT")} FROM raw_state),
stg_state AS (
    SELECT geography_name AS state_name, state AS state_fips, {", ".join(_COUNTS)},
        broadband_penetration_pct, data_source, ingested_at, loaded_at
    FROM typed_state WHERE total_households > 0
),
typed_county AS (SELECT * EXCLUDE ({", ".join(_COUNTS)}), {_cast("INTEGER")} FROM raw_county),
stg_county AS (
    SELECT geography_name AS county_name, county AS county_fips, state AS state_fips,
        {", ".join(_COUNTS)}, broadband_penetration_pct,
        COALESCE(5 * CAST(households_no_internet AS BIGINT) > total_households, FALSE) AS is_underserved,
        data_source, ingested_at, loaded_at
    FROM typed_county WHERE total_households > 0
)"""

# intervals [low, high) of the labels; an unknown share counts as the number in the last column
BOUNDS_CTES = """
tiers(access_tier, low, high) AS (VALUES ('Critical Gap', -1e300, 80), ('Low Access', 80, 85),
    ('Medium Access', 85, 90), ('High Access', 90, 1e300)),
severities(underserved_severity, low, high) AS (VALUES ('Critical', -1e300, 70), ('Severe', 70, 80),
    ('Moderate', 80, 85), ('Marginal', 85, 1e300))"""
TIER_JOIN = "JOIN tiers ON COALESCE({p}, -1) >= tiers.low AND COALESCE({p}, -1) < tiers.high"
SEVERITY_JOIN = "JOIN severities ON COALESCE({p}, 1000) >= severities.low AND COALESCE({p}, 1000) < severities.high"


def rank_of(table: str, value: str, me: str) -> str:
    """One more than the rows of ``table`` that are strictly greater; unknown values come after all known ones."""
    return (f"(SELECT COUNT(*) + 1 FROM {table} o WHERE o.{value} > {me}.{value} "
            f"OR ({me}.{value} IS NULL AND o.{value} IS NOT NULL))")


MART_CTES = f"""
mart_state AS (
    SELECT s.state_name, s.state_fips, {", ".join(f"s.{c}" for c in _COUNTS)}, s.broadband_penetration_pct,
        {rank_of("stg_state", "broadband_penetration_pct", "s")} AS broadband_rank,
        ROUND(s.households_fiber_optic * 100.0 / s.total_households, 2) AS fiber_penetration_pct,
        ROUND(s.households_no_internet * 100.0 / s.total_households, 2) AS no_internet_pct,
        tiers.access_tier, s.data_source, s.loaded_at
    FROM stg_state s {TIER_JOIN.format(p="s.broadband_penetration_pct")}
),
parents AS (SELECT state_fips, MAX(state_name) AS state_name, MAX(broadband_penetration_pct) AS state_broadband_pct
            FROM stg_state GROUP BY state_fips),
mart_underserved AS (
    SELECT c.county_name, c.county_fips, c.state_fips, parents.state_name,
        c.total_households, c.households_broadband_any, c.households_no_internet,
        c.broadband_penetration_pct AS county_broadband_pct, parents.state_broadband_pct,
        ROUND(parents.state_broadband_pct - c.broadband_penetration_pct, 2) AS pct_below_state_avg,
        ROUND(c.households_no_internet * 100.0 / c.total_households, 2) AS no_internet_pct,
        TRUE AS is_underserved, severities.underserved_severity, c.loaded_at
    FROM (SELECT * FROM stg_county WHERE is_underserved) c
        {SEVERITY_JOIN.format(p="c.broadband_penetration_pct")}
        LEFT JOIN parents USING (state_fips)
)"""


def mean(x: str, digits: int = 2) -> str:
    """The exact mean, rounded: independent of the order in which doubles are added (README lists where it shows)."""
    return f"ROUND(AVG(CAST({x} AS DECIMAL(38,12))), {digits})"


def with_layers(body: str, *, staging: bool = True, marts: bool = True,
                extra: str | None = None) -> str:
    """``WITH <layers>[, <extra CTEs>] <body>``."""
    ctes = [RAW_CTES, BOUNDS_CTES]
    if staging or marts:
        ctes.append(STAGING_CTES)
    if marts:
        ctes.append(MART_CTES)
    if extra:
        ctes.append("\n" + extra.strip())
    return "WITH " + ",".join(ctes) + "\n" + body.strip()


def raw_only(body: str, extra: str | None = None) -> str:
    return with_layers(body, staging=False, marts=False, extra=extra)


def staged(body: str, extra: str | None = None) -> str:
    return with_layers(body, marts=False, extra=extra)
