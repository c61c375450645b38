"""Rounding and averaging that do not depend on engine quirks or row order."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# 2**27 + 1: splits a double into two halves whose products with a small whole
# number are exact (Veltkamp / Dekker).
_SPLIT = 134217729.0
# Below this the products with a power of ten are exact as a rounded part plus its error.
_LIMIT = 1e13
# From here on a double is a whole number.
_WHOLE = 2.0**52


def half_even(x: Column, places: int) -> Column:
    """Round the exact binary value to ``places`` digits, ties to the even digit.

    Spark's ``round`` and ``bround`` look at the shortest decimal text instead:
    24.15 is stored as slightly less than 24.15, so it has to give 24.1.
    Of large numbers only the part behind the point is rounded, which is exact too.
    """
    if places == 0:
        return F.rint(x)
    whole = F.when(F.abs(x) < _WHOLE, F.floor(x)).cast("double")
    # NaN, infinities and numbers without a fraction fail both tests and pass through.
    return (
        F.when(F.abs(x) < _LIMIT, _half_even_below(x, places))
        .when(F.abs(x) < _WHOLE, whole + _half_even_below(x - whole, places))
        .otherwise(x)
    )


def _half_even_below(x: Column, places: int) -> Column:
    """The product ``x * 10**places`` is kept as a rounded part plus its exact error."""
    scale = float(10**places)
    high = F.lit(_SPLIT) * x - (F.lit(_SPLIT) * x - x)
    low = x - high
    product = x * F.lit(scale)
    error = (high * F.lit(scale) - product) + low * F.lit(scale)
    base = F.floor(product).cast("double")
    above_half = (product - base - F.lit(0.5)) + error
    step = F.when(above_half > 0, 1.0).when(
        (above_half == 0) & (F.pmod(base, F.lit(2.0)) == 1.0), 1.0
    )
    return (base + F.coalesce(step, F.lit(0.0))) / F.lit(scale)


def steady_avg(x: Column) -> Column:
    """Average that the order of the rows does not change for values of up to six decimals.

    A sum of doubles depends on the order in which tasks finish.  Here whole
    parts and millionths are summed as whole numbers, which is exact and keeps the
    aggregation buffer fixed-width; decimal arithmetic appears once per group, not per row.
    What a value has beyond its millionths, and a value too large for that split
    (or NaN, or infinite), goes to a plain sum of doubles beside them, row by row.
    """
    x = x.cast("double")
    usable = F.abs(x) < 1e12
    whole = F.when(usable, x).cast("bigint")
    millionths = F.when(usable, F.rint((x - whole) * 1e6)).cast("bigint")
    # A double next to a number of six decimals stands for that number.
    beyond = F.abs(x - (whole + millionths / F.lit(1e6))) > F.abs(x) * 1e-15
    rest = F.when(usable, F.when(beyond, (x - whole) - millionths / F.lit(1e6)).otherwise(0.0)).otherwise(x)
    zero = F.lit(0).cast("decimal(20,0)")
    total = F.coalesce(F.sum(whole).cast("decimal(20,0)"), zero) + F.coalesce(
        F.sum(millionths).cast("decimal(20,0)"), zero
    ) * F.lit(Decimal("0.000001"))
    return (total.cast("double") + F.sum(rest)) / F.nullif(F.count(x), F.lit(0)).cast("double")
