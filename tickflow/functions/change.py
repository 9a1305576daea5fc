"""Arithmetic and label scalars (SCL-8..15, SCL-17, FLT-7)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class names used by the reports.
CLASS_NAMES = {0: "sell", 1: "buy"}


def pct_change(cur: Column, prev: Column) -> Column:
    """SCL-9: (cur - prev) / prev; null when prev is null or zero (Q22:
    ``try_divide``, since ANSI mode raises on a plain division by zero)."""
    return F.try_divide(cur - prev, prev)


def prior_from_change(cur: Column, change: Column) -> Column:
    """SCL-10: recover the earlier price from a fractional change."""
    return F.try_divide(cur, F.lit(1.0) + change)


def direction(change: Column) -> Column:
    """SCL-12: 1 when the change is positive, else 0 (null counts as 0)."""
    return F.when(change > 0, F.lit(1)).otherwise(F.lit(0))


def class_name(label: Column) -> Column:
    """SCL-13."""
    return (F.when(label == 0, F.lit(CLASS_NAMES[0]))
            .when(label == 1, F.lit(CLASS_NAMES[1])))


# Values below LIMIT in magnitude are summed as decimals with 18 places; a
# double sum would depend on the order rows arrive in. 19 integer digits leave
# room for 10^7 values at the limit. Others (NaN, infinite, larger) are `odd`.
EXACT = "decimal(37,18)"
LIMIT = 1e12


def exact(value: Column) -> Column:
    """The value as a decimal; 0 for an odd value, null for null."""
    fits = F.abs(value) < F.lit(LIMIT)
    return F.when(value.isNull(), F.lit(None)).when(fits, value).otherwise(F.lit(0)).cast(EXACT)


def odd(value: Column) -> Column:
    """1 for a value that ``exact`` cannot hold, else 0."""
    return F.when(value.isNotNull() & ~(F.abs(value) < F.lit(LIMIT)), F.lit(1)).otherwise(F.lit(0))


def unbounded(value: Column) -> Column:
    """1 for NaN and infinities, else 0."""
    return F.when(value.isNotNull() & ~(F.abs(value) < F.lit(float("inf"))),
                  F.lit(1)).otherwise(F.lit(0))


# Finite values from LIMIT on are cut into tiers of ten decades. A power of two
# (which changes no digit) brings each tier down to about LIMIT, where 6 places
# hold a double's digits and 32 integer digits leave room for 10^10 values.
TIER = "decimal(38,6)"
TIER_DECADES = 10


def tier(value: Column) -> Column:
    """1, 2, ... for a finite value from ``LIMIT`` on, else 0."""
    size = F.abs(value.cast("double"))
    large = (size >= F.lit(LIMIT)) & (size < F.lit(float("inf")))
    steps = (F.log10(size) - F.lit(math.log10(LIMIT))) / F.lit(float(TIER_DECADES))
    return F.when(large, F.floor(steps).cast("int") + 1).otherwise(F.lit(0))


def tier_scale(n: int) -> float:
    return 2.0 ** round(TIER_DECADES * (n - 1) * math.log2(10))


def in_tier(value: Column, n: int) -> Column:
    """The value over ``tier_scale(n)`` as a decimal; 0 outside the tier."""
    scaled = value if n == 1 else value.cast("double") / F.lit(tier_scale(n))
    return F.when(tier(value) == n, scaled).otherwise(F.lit(0)).cast(TIER)


def exact_sum(value: Column) -> Column:
    """Sum of a double column, the same for any partitioning. Odd values are
    added as doubles, so NaN and infinities show in the result, and a decimal
    total out of range falls back to the double sum."""
    rest = F.sum(F.when(odd(value) == 1, value).otherwise(F.lit(0.0)))
    total = F.try_sum(exact(value)).cast("double")
    return F.coalesce(F.when(rest == 0, total).otherwise(total + rest), F.sum(value))


def clip_below(value: Column, threshold: float = 0.5) -> Column:
    """FLT-7: values under the threshold become 0."""
    return F.when(value < threshold, F.lit(0.0)).otherwise(value)


def whole_units(value: Column) -> Column:
    """SCL-17: round to the whole currency unit (half away from zero)."""
    return F.round(value, 0)
