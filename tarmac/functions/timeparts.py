"""Day, hour and duration expressions on TIMESTAMP / TIMESTAMP_NTZ columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values -- part-of-day buckets by hour of the scheduled departure,
# half-open ranges [start, end) and their labels.
DAY_PERIODS = [
    ("Early Morning", 0, 6),
    ("Morning", 6, 12),
    ("Afternoon", 12, 18),
    ("Evening", 18, 24),
]


def day_of(ts: Column) -> Column:
    """Calendar day as DATE (grouping key; formatted to text only at the end)."""
    return F.to_date(ts)


def day_string(ts_or_day: Column) -> Column:
    """Day as 'yyyy-MM-dd' text."""
    return F.date_format(ts_or_day, "yyyy-MM-dd")


def seconds_between(later: Column, earlier: Column) -> Column:
    """Whole seconds from ``earlier`` to ``later`` (fractions dropped first)."""
    return F.unix_timestamp(later) - F.unix_timestamp(earlier)


def hour_of_day(ts: Column) -> Column:
    """Hour of a timestamp, or of its text."""
    return F.hour(ts.cast("timestamp"))


def day_period(hour: Column) -> Column:
    """Label of the part of day; NULL hour -> NULL label."""
    expr = None
    for label, start, end in DAY_PERIODS:
        cond = (hour >= start) & (hour < end)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr
