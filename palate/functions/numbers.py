"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_half_even(value: Column, digits: int) -> Column:
    """Scale, round to the nearest even integer, scale back (array-library rounding)."""
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def to_number(value: Column) -> Column:
    """Coerce to double; anything unparseable, or not a number, becomes null."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def micros(ts: Column) -> Column:
    """Microseconds since the epoch; works for timestamps with and without a zone."""
    return F.unix_micros(ts.cast("timestamp"))


def whole_days(later: Column, earlier: Column) -> Column:
    """Completed 24-hour periods between two timestamps, floored (not calendar midnights)."""
    return F.floor((micros(later) - micros(earlier)) / F.lit(86_400_000_000)).cast("long")


def percent_lift(value: Column, base: Column) -> Column:
    """Percentage by which value exceeds base; null where base is zero."""
    return (F.try_divide(value, base) - F.lit(1.0)) * F.lit(100.0)
