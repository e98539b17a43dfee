"""Numeric helpers shared by the report operators.

``rnd`` is round-half-away-from-zero, the rounding the reference's SQL uses
(``ROUND(x::NUMERIC, n)``). That SQL first converts the double to NUMERIC
with 15 significant digits, which snaps a value one ulp below a tie onto the
tie; ``rnd`` gets the same effect with a 1e-9 tolerance on the scaled value,
so results do not depend on summation order. ``exact_avg`` is the mean of
the values at 10 decimals, summed so that the executor layout does not matter.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TIE_TOLERANCE = 1e-9


def rnd(c: Column, n: int) -> Column:
    """Round half away from zero to ``n`` decimals, as a double."""
    scale = float(10 ** n)
    sign = F.when(c < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    rounded = sign * F.floor(F.abs(c) * F.lit(scale) + F.lit(0.5) + F.lit(TIE_TOLERANCE)) / F.lit(scale)
    # A double this large has no decimals to round, and its scaled value no place in a BIGINT.
    return F.when(F.abs(c) * F.lit(scale) >= F.lit(2.0 ** 53), c).otherwise(rounded)


def clamp(c: Column, lo: float, hi: float) -> Column:
    """``max(lo, min(hi, c))``; callers keep NaN out beforehand."""
    return F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), c))


def exact_avg(c: Column) -> Column:
    """Mean of a double column; NULL for no values.

    Values of up to 18 integer digits are rounded to 10 decimals and summed as
    DECIMAL(38, 10), which no executor layout changes (ranks and ties are stable),
    and divided once. If any value does not fit, the plain double mean stands in.
    """
    p = mean_parts(c)
    return mean_of(p["exact"], p["fitting"], p["n"], p["total"])


def mean_parts(c: Column) -> dict[str, Column]:
    """Aggregates that add up over any split of the rows and give the mean by :func:`mean_of`."""
    d = c.try_cast("decimal(28,10)")
    return {"exact": F.sum(d), "fitting": F.count(d), "n": F.count(c), "total": F.sum(c)}


def mean_of(exact: Column, fitting: Column, n: Column, total: Column) -> Column:
    """The mean from the sums of :func:`mean_parts`; NULL for no values."""
    whole = F.nullif(n, F.lit(0))
    return F.when(fitting == n, exact.cast("double") / whole).otherwise(total / whole)
