"""Number expressions that give null, never an error, for text or results that are no such number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_int(value: Column) -> Column:
    """The whole part of a number or of its text."""
    return value.try_cast("double").try_cast("int")


def to_decimal(value: Column, precision: int = 18, scale: int = 2) -> Column:
    return value.try_cast(f"decimal({precision},{scale})")


def to_area(value: Column) -> Column:
    """A size without its sign; a missing one is zero."""
    return F.coalesce(F.abs(to_decimal(value, 18, 4)), F.lit(0).cast("decimal(18,4)"))


def to_float(value: Column) -> Column:
    return value.try_cast("float")


def price_per_unit(price: Column, units: Column) -> Column:
    """Price by unit with two decimals, half up; null when there are no units."""
    return F.round(F.try_divide(to_decimal(price), to_decimal(units, 18, 4)), 2).try_cast("decimal(18,2)")
