"""Number expressions: rounding, means from parts, blank arithmetic, real rates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

def round4(value: Column) -> Column:
    return F.round(value, 4)


def mean_of(total: Column, count: Column) -> Column:
    """Mean from a sum and a count; null when nothing was counted."""
    return F.try_divide(total.cast("double"), count.cast("double"))


def single_value(value: Column) -> Column:
    """The value if the group holds exactly one distinct value, else null.

    A null beside a value counts as a second value. Minimum, maximum and two
    counts decide this, so no distinct values are shuffled.
    """
    alone = (F.min(value) == F.max(value)) & (F.count(value) == F.count(F.lit(1)))
    return F.when(alone, F.max(value))


def blank_minus(left: Column, right: Column) -> Column:
    """Subtraction where a missing side counts as zero and two missing sides stay missing."""
    difference = F.coalesce(left, F.lit(0.0)) - F.coalesce(right, F.lit(0.0))
    return F.when(left.isNotNull() | right.isNotNull(), difference)


def is_filled(value: Column) -> Column:
    """Comparison with blank: zero equals blank, so only a non-zero value is filled."""
    return value.isNotNull() & (value != 0)


def real_rate(nominal: Column, inflation: Column) -> Column:
    """Exact Fisher rate in percent, 4 digits; null when inflation is -100 %."""
    growth = F.lit(1.0) + nominal / 100.0
    prices = F.lit(1.0) + inflation / 100.0
    return round4((F.try_divide(growth, prices) - 1.0) * 100.0)


# Colours of the divergence columns and of the comparison table.
TOP5_HIGHER = "#E66C37"
TOP5_LOWER = "#A4AAAD"
TABLE_LOWER = "#23282B"
TABLE_EQUAL = "#8C969A"


def divergence_colour(value: Column) -> Column:
    """Blank compares as zero, so it takes the colour of "not lower"."""
    return F.when(F.coalesce(value, F.lit(0.0)) >= 0, TOP5_HIGHER).otherwise(TOP5_LOWER)


def table_colour(value: Column) -> Column:
    return F.when(value > 0, TOP5_HIGHER).when(value < 0, TABLE_LOWER).otherwise(TABLE_EQUAL)
