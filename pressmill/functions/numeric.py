"""Division that is defined at zero, and rates built on it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """0.0 where the denominator is zero (or NULL)."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")),
                      F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    return safe_divide(part, whole) * 100


def reduction_percent(before: Column, after: Column) -> Column:
    return percent(before - after, before)
