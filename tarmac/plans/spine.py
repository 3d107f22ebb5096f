"""The dense (day x airport name) grid the mart is reported on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.timeparts import day_of, day_string
from tarmac.operators.ordering import SLOT, slot_count, with_slots
from tarmac.plans.airports import clean_airports


def spine_days(departures: DataFrame, bookings: DataFrame) -> DataFrame:
    """Distinct DATE ``day`` of every scheduled departure (any status) and of
    every booking.  Each side is reduced map-side before the tiny shuffle."""
    flight_days = departures.select(day_of(F.col("scheduled_departure")).alias("day"))
    book_days = bookings.select(day_of(F.col("book_date")).alias("day"))
    return flight_days.union(book_days).distinct()


def spine(
    airports_data: DataFrame,
    departures: DataFrame,
    bookings: DataFrame,
    lang: str | None = None,
) -> DataFrame:
    """(day DATE, airport_name, slot): every reporting day with every distinct name.

    This Cartesian product IS the output grid -- every pair becomes one mart
    row -- so its size is the result size.  Spark broadcasts the names when
    their statistics allow it.  The days are dealt by their slot (the run of
    days that one partition of the ordered result holds), so the grid is
    generated in parallel, and its order needs no sample.
    """
    return grid(spine_days(departures, bookings), airports_data, lang)


def grid(days: DataFrame, airports_data: DataFrame, lang: str | None = None) -> DataFrame:
    """(day, airport_name, slot): each of the distinct ``days`` with every distinct name."""
    names = clean_airports(airports_data, lang).select("airport_name").distinct()
    slots = slot_count(days.sparkSession)
    return with_slots(days, slots).repartitionById(slots, SLOT).crossJoin(names)


def date_airport_spine(
    airports_data: DataFrame, departures: DataFrame, bookings: DataFrame, lang: str | None = None
) -> DataFrame:
    """Public form: (date 'yyyy-MM-dd', airport_name)."""
    return spine(airports_data, departures, bookings, lang).select(
        day_string(F.col("day")).alias("date"), "airport_name"
    )
