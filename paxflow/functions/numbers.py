"""Arithmetic with the rounding and guard rules of the data model."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def whole_count(value: Column) -> Column:
    """Half-to-even rounding, floor at zero, whole number."""
    return F.greatest(F.lit(0.0), F.rint(value)).cast("int")


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient, null where the denominator is zero or missing."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def ratio_or_one(top: Column, bottom: Column) -> Column:
    """Quotient where the denominator is positive, else 1; a missing numerator stays missing."""
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(1.0))


def ceil_div(value: Column, size: int) -> Column:
    return F.ceil(value / F.lit(size)).cast("int")
