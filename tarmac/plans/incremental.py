"""The mart kept up to date: stored sums of which only changed days are computed anew.

The stored table (``sources.versions``, partitioned by month) holds, for every
day, sums by (departure airport code, aircraft code) of all departure-based
metrics, the bookings by departure airport code, and one row that marks the day
as a reporting day.  All of it adds up, and names, seats and ratios are applied
when the mart is read, so a change of the airport, aircraft or seat tables
needs no new sums.

``refresh`` takes the days whose departures or bookings changed.  Departures and
bookings of these days only are read (the condition reaches the scan), and the
segments and tickets that they join; the other days of the months concerned are
copied.  The change is published in one step.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.timeparts import day_string
from tarmac.operators.joins import left_join
from tarmac.plans.mart import departure_sums, finish, metrics_of_sums
from tarmac.plans.metrics import bookings_by_day_and_code, by_name
from tarmac.plans.spine import grid, spine_days
from tarmac.sources import versions

#: First and last day of a range, each included; None: open.  A None for a range is the days of NULL times.
Days = tuple[date | None, date | None] | None
EVERY_DAY: tuple[Days, ...] = ((None, None), None)


def _within(time: Column, days: Sequence[Days]) -> Column:
    """Whether a time (or date) lies in one of the ranges; plain comparisons, which scans understand."""

    def one(r: Days) -> Column:
        if r is None:
            return time.isNull()
        first, last = r
        cond = time.isNotNull()
        if first is not None:
            cond = cond & (time >= F.lit(first).cast("timestamp_ntz"))
        if last is not None:
            cond = cond & (time < F.lit(last + timedelta(days=1)).cast("timestamp_ntz"))
        return cond

    return reduce(or_, map(one, days), F.lit(False))


def day_sums(tables: Mapping[str, DataFrame], days: Sequence[Days] = EVERY_DAY) -> DataFrame:
    """The rows of the stored table for the given days, with ``month``."""
    departures = tables["departures"].filter(_within(F.col("scheduled_departure"), days))
    bookings = tables["bookings"].filter(_within(F.col("book_date"), days))
    carried = tables["segments"].join(departures.select("flight_id").distinct(), "flight_id", "left_semi")
    ops = departure_sums(departures, carried)
    booked = bookings_by_day_and_code(bookings, tables["tickets"], tables["segments"], tables["departures"])
    rows = ops.unionByName(booked, allowMissingColumns=True)
    rows = rows.unionByName(spine_days(departures, bookings), allowMissingColumns=True)
    return rows.withColumn("month", F.date_format("day", "yyyy-MM"))


def _touches(days: Sequence[Days]):
    """Whether a partition (``month=1996-01``) has a day of the ranges."""

    def run(part: str) -> bool:
        month = part.partition("=")[2]
        if not month[:1].isdigit():  # the partition of NULL days
            return None in days
        return any(
            r is not None and (r[0] is None or month >= f"{r[0]:%Y-%m}") and (r[1] is None or month <= f"{r[1]:%Y-%m}") for r in days
        )

    return run


def refresh(spark: SparkSession, tables: Mapping[str, DataFrame], root: str, days: Sequence[Days] = EVERY_DAY) -> versions.Manifest:
    """Compute the sums of the given days anew and put them in place of the old ones."""
    old, new = versions.newest_manifest(spark, root), day_sums(tables, days)
    touched = _touches(days)
    if old is not None:
        months = [p.partition("=")[2] for p in old.parts if touched(p)]
        stored = versions.read_table(spark, root)
        same = stored.filter(F.col("month").isin(months) if months else F.lit(False))
        new = new.unionByName(same.filter(~_within(F.col("day").cast("timestamp_ntz"), days)))
    return versions.overwrite(new.repartition("month"), root, ["month"], dynamic=old is not None, remove=touched)


def stored_mart(
    spark: SparkSession,
    root: str,
    aircrafts_data: DataFrame,
    airports_data: DataFrame,
    seats: DataFrame,
    lang: str | None = None,
) -> DataFrame:
    """The 14-column mart of the stored sums."""
    sums = versions.read_table(spark, root).drop("month")
    ops = metrics_of_sums(sums.filter("departures IS NOT NULL").drop("bookings"), seats, aircrafts_data, airports_data, lang)
    booked = by_name(sums.filter("bookings IS NOT NULL").select("day", "departure_airport", "bookings"), airports_data, lang)
    keys = ["day", "airport_name"]
    joined = left_join(left_join(grid(sums.select("day").distinct(), airports_data, lang), ops, keys), booked, keys)
    return finish(joined.withColumn("date", day_string(F.col("day"))))
