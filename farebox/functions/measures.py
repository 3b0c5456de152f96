"""Aggregate expressions.

Sums and means take whole values, however small or large, and do not depend on the order in which tasks
finish: the first digits of each value are added up as decimals, which is exact, and what lies beyond
them, which is next to nothing for measured values, as doubles. So a number is rounded once, where it is shown.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Digits after the point that numbers are shown with where nothing else is said.
STABLE_DIGITS = 6
# Digits after the point that are added up as decimals, and from where on values are not.
EXACT_DIGITS, LARGE = 10, 1e15


def total(c: Column) -> Column:
    """Sum of the non-NULL values; NULL without one."""
    value = c.cast("double")
    # A decimal of 26 digits holds any value below LARGE, and its sum those of 10 ** 10 rows.
    first = F.when(F.abs(value) < LARGE, value.cast(f"decimal(26,{EXACT_DIGITS})"))
    rest = value - F.coalesce(first.cast("double"), F.lit(0.0))
    return F.coalesce(F.sum(first).cast("double"), F.lit(0.0)) + F.sum(rest)


def ratio(total: Column, n: Column) -> Column:
    """``total / n`` as double; NULL for an empty group."""
    return F.try_divide(total.cast("double"), n.cast("double"))


def mean(c: Column) -> Column:
    """Mean of the non-NULL values."""
    return ratio(total(c), F.count(c.cast("double")))


def shown(c: Column, digits: int = STABLE_DIGITS) -> Column:
    """Rounded for a reader, half away from zero."""
    return F.round(c, digits)


def correlation(a: Column, b: Column) -> Column:
    """Pearson correlation over rows where both sides are set.

    NULL when a side does not vary; the built-in ``corr`` raises there.
    """
    left = F.when(b.isNotNull(), a.cast("double"))
    right = F.when(a.isNotNull(), b.cast("double"))
    return F.try_divide(F.covar_pop(left, right), F.stddev_pop(left) * F.stddev_pop(right))


def clipped_index(c: Column, factor: float, low: int, high: int) -> Column:
    """``factor * c`` rounded half to even and held within ``[low, high]``."""
    scaled = F.bround(c * F.lit(factor), 0)
    held = F.least(F.greatest(scaled, F.lit(float(low))), F.lit(float(high)))
    return F.when(c.isNotNull(), held).cast("int")
