"""Column expressions that pin down the reference's numeric semantics.

All helpers return JVM-side Column expressions (no Python UDFs), so they
stay inside whole-stage codegen.

* ``round_half_away`` — SQL ``ROUND(double, d)``: scale in binary, round
  half away from zero, unscale.  ``F.round(x, d)`` instead rounds the
  printed decimal (``1.005`` → 1.01 where SQL gives 1.0).
* ``round_half_even`` — pandas/numpy ``.round(d)``: scale in binary, round
  half to even, unscale.
* ``cast_int`` — SQL ``CAST(double AS INTEGER)`` rounds half to even;
  Spark's cast truncates, so round first.
* ``nullif_zero`` / ``pct_of`` — zero-safe ratios (``NULLIF(den, 0)``).
* ``band`` — first-match ``CASE WHEN`` ladder; nulls fall to the ELSE label.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_half_away(x, digits: int = 2) -> Column:
    scale = float(10 ** digits)
    return F.round(_c(x) * scale, 0) / scale


def round_half_even(x, digits: int = 2) -> Column:
    scale = float(10 ** digits)
    return F.rint(_c(x) * scale) / scale


def avg_rounded(x, digits: int = 2) -> Column:
    """``ROUND(AVG(x), digits)`` with an accurate, order-independent mean.

    A plain double sum is off by a few ulps depending on the order partial
    sums meet, and ``ROUND`` turns that into a different answer whenever
    the mean sits on ``.xx5``.  The values are summed as decimals (exact),
    the mean converted to the nearest double, then rounded like SQL ``ROUND``.
    """
    exact = F.avg(_c(x).try_cast("decimal(38,12)")).cast("double")
    # infinities and NaN are no decimals: with one of them the mean is what doubles give
    finite = F.max(F.abs(_c(x))) < float("inf")
    return round_half_away(F.when(finite, exact).otherwise(F.avg(x)), digits)


def cast_int(x, kind: str = "int") -> Column:
    """Half-to-even rounding cast of a numeric or numeric-text column (``kind``: int or bigint)."""
    return F.rint(_c(x).cast("double")).cast(kind)


# what counts as a number: decimal digits with point and exponent, or infinity
NUMBER = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))$"


def coerce_double(x) -> Column:
    """Lenient text → double: what is no number (also ``1d``, ``0x1p3``, ``NaN``) gives NULL, never an error."""
    text = F.trim(_c(x).cast("string"))
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def nullif_zero(x) -> Column:
    return F.nullif(_c(x), F.lit(0))


def pct_of(num, den, digits: int = 2) -> Column:
    """``ROUND(num * 100.0 / NULLIF(den, 0), digits)`` — multiply first."""
    return round_half_away(_c(num) * 100.0 / nullif_zero(den), digits)


def share_pct(part, whole, digits: int = 2) -> Column:
    """Ingest-time share: ``(part / whole * 100).round(digits)`` — divide first,
    half-even; a zero or missing ``whole`` gives NULL."""
    return round_half_even(_c(part) / nullif_zero(whole) * 100.0, digits)


def band(value, ladder: Sequence[tuple[str, float, str]], otherwise: str) -> Column:
    """``CASE WHEN value <op> bound THEN label ... ELSE otherwise END``.

    ``ladder`` items are ``(op, bound, label)`` with op one of
    ``'>=' '>' '<' '<='``; the first true test wins, NULL goes to ELSE.
    """
    v = _c(value)
    ops = {">=": v.__ge__, ">": v.__gt__, "<": v.__lt__, "<=": v.__le__}
    expr = None
    for op, bound, label in ladder:
        cond = ops[op](F.lit(float(bound)))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(otherwise) if expr is not None else F.lit(otherwise)


# ── fixed values: labels and thresholds that must equal the reference's ───────
# access tier of a region, by broadband penetration (>=, first match wins)
ACCESS_TIERS = [(">=", 90, "High Access"), (">=", 85, "Medium Access"),
                (">=", 80, "Low Access")]
ACCESS_TIER_ELSE = "Critical Gap"
# severity of an underserved sub-region, by broadband penetration (<)
SEVERITY_BANDS = [("<", 70, "Critical"), ("<", 80, "Severe"), ("<", 85, "Moderate")]
SEVERITY_ELSE = "Marginal"
# a sub-region is underserved when no-internet households exceed this share
UNDERSERVED_RATIO = 0.20
# gap index weights: 0.6 x gap to parent + 0.4 x no-internet share
GAP_WEIGHT = 0.6
NO_INTERNET_WEIGHT = 0.4
# fiber ranking: top-N leaders, bottom-N laggards
FIBER_EDGE = 10
