"""Small numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def value_or_zero(value: Column) -> Column:
    return F.coalesce(F.nanvl(value, F.lit(0.0)), F.lit(0.0))


def number_or_zero(value: Column) -> Column:
    """Any value as a finite DOUBLE, else 0."""
    number = value.try_cast("double")
    finite = number.isNotNull() & ~F.isnan(number) & (F.abs(number) != float("inf"))
    return F.when(finite, number).otherwise(F.lit(0.0))


def percent(value: Column) -> Column:
    """Fraction as a percentage with one decimal."""
    return F.round(number_or_zero(value) * 100, 1)


def accepted_percent(valid: Column, total: Column) -> Column:
    return F.round(valid / F.greatest(total, F.lit(1)) * 100, 2)


def share_of_max(value: Column, floor_percent: float = 3.0) -> Column:
    """Percentage of the largest value in the (already aggregated) report, with a floor."""
    top = F.max(value).over(Window.partitionBy(F.lit(0)))
    return F.greatest(F.lit(floor_percent), value / top * 100)
