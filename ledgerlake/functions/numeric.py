"""Exact arithmetic for money sums, averages and rounded ratios.

Sums of doubles depend on the order in which a shuffle delivers rows, so two
runs (or two engines) can differ in the last bit. ``exact_sum`` adds the amounts
as they are written (the shortest decimal of each double), without rounding any:

* amounts with at most two decimals as whole hundredths,
* others as a high part of 14 decimals and a low part of what lies beyond,
* amounts of 1e13 and more, infinities and NaN as doubles (the only part whose
  last bits depend on the order).

Each part is an exact decimal sum, whatever the order of the rows; only the
final values are turned into doubles and added.

Rounded ratios are computed with integer arithmetic: ``round_ratio`` yields
the exact half-up rounding of ``factor * num / den``; the result is the
nearest double to ``k / 10**digits`` for an exact integer ``k``.  Rounding a
double instead would depend on how each engine represents ties in binary.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def exact_sum_sql(x: str, weight: str | None = None) -> str:
    """SQL of ``exact_sum`` over the column expressions ``x`` and ``weight``."""
    hundredths = f"rint({x} * 100D)"
    small = f"abs({x}) < 1e13D"
    even = f"{small} AND {hundredths} / 100D = {x}"
    fine = f"{small} AND {hundredths} / 100D != {x}"
    written = f"CAST({x} AS DECIMAL(37,24))"
    high = f"CAST({written} AS DECIMAL(27,14))"
    times = f" * CAST({weight} AS DECIMAL({{}},0))" if weight else ""
    whole_sum = f"SUM(CASE WHEN {even} THEN CAST(CAST({hundredths} AS BIGINT) AS DECIMAL(16,0)){times.format(19)} END)"
    high_sum = f"SUM(CASE WHEN {fine} THEN {high}{times.format(10)} END)"
    low_sum = f"SUM(CASE WHEN {fine} THEN CAST({written} - {high} AS DECIMAL(24,24)){times.format(10)} END)"
    large_sum = f"SUM(CASE WHEN NOT ({small}) THEN {x}{f' * {weight}' if weight else ''} END)"
    parts = [f"CAST(CAST({whole_sum} AS DECIMAL(35,0)) * 0.01BD AS DOUBLE)", f"CAST({high_sum} AS DOUBLE)",
             f"CAST({low_sum} AS DOUBLE)", f"CAST({large_sum} AS DOUBLE)"]
    counted = f"COUNT(CASE WHEN {weight} IS NOT NULL THEN {x} END)" if weight else f"COUNT({x})"
    return f"CASE WHEN {counted} > 0 THEN " + " + ".join(f"COALESCE({p}, 0D)" for p in parts) + " END"


def exact_sum(col: str, weight: str | None = None) -> Column:
    """SUM(col), or SUM(col * weight), of a double column: exact and order independent, NULL for no rows.

    ``weight`` is a whole number (below 1e10 for amounts of more than two decimals).
    """
    return F.expr(exact_sum_sql(f"`{col}`", f"`{weight}`" if weight else None))


def ratio(num: Column, den: Column) -> Column:
    """num / den as double, NULL when den is 0 or NULL."""
    return num.cast("double") / F.nullif(den, F.lit(0)).cast("double")


def exact_avg(col: str) -> Column:
    """AVG of a double column: exact sum over the non-null count."""
    return ratio(exact_sum(col), F.count(_c(col)))


def _div(a: Column, b: Column) -> Column:
    # Integral division of longs; NULL divisor gives NULL.
    return F.call_function("div", a, b)


def round_ratio(num: Column, den: Column, factor: int = 1, digits: int = 2) -> Column:
    """ROUND(factor * num / den, digits), exact half-up, for num >= 0, den > 0.

    NULL when den is 0 or NULL (the NULLIF guard of the SQL form).
    """
    scale = 10 ** digits
    den_nz = F.nullif(den, F.lit(0)).cast("long")
    k = _div(num.cast("long") * (2 * factor * scale) + den_nz, den_nz * 2)
    return k.cast("double") / F.lit(float(scale))


def round_half_even_ratio(num: Column, den: Column, factor: int = 1, digits: int = 1) -> Column:
    """round(factor * num / den, digits) with ties to even, for num >= 0, den > 0."""
    scale = 10 ** digits
    den_nz = F.nullif(den, F.lit(0)).cast("long")
    scaled = num.cast("long") * (factor * scale)
    k0 = _div(scaled, den_nz)
    twice_rest = (scaled - k0 * den_nz) * 2
    bump = (F.when(twice_rest > den_nz, 1)
             .when((twice_rest == den_nz) & (F.pmod(k0, F.lit(2)) == 1), 1)
             .otherwise(0))
    return (k0 + bump).cast("double") / F.lit(float(scale))
