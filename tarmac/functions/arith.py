"""Numeric helpers that stay ANSI-safe."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def truncate_to_long(c: Column) -> Column:
    """Decimal/double -> bigint, truncating toward zero."""
    return c.cast("long")


def round2(c: Column) -> Column:
    """Round half up to two decimals (Spark rounds the decimal representation)."""
    return F.round(c, 2)


def minutes_from_seconds(seconds: Column) -> Column:
    return seconds / F.lit(60)


def percent_of(part: Column, whole: Column) -> Column:
    """round(part / whole * 100, 2); a zero or NULL whole gives NULL, never an error."""
    return F.round(F.try_divide(part, whole) * F.lit(100), 2)
