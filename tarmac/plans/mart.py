"""The daily per-airport mart (14 columns), fused into one pass.

Plan, instead of eight separate scans of departures and seven joins:

  per_departure = segments grouped by flight_id (revenue, passengers, per class)
  coded    = completed departures LEFT JOIN per_departure (shuffle on flight_id)
             -> one groupBy(day, airport code, aircraft code) whose conditional
                sums apply each metric's own row filter
  ops      = coded LEFT JOIN seats by aircraft code (seats x departures)
             -> sums by (day, airport code) LEFT JOIN names
             -> sums by (day, airport_name)
  booked   = metrics.bookings_by_day_and_code, then names
  mart     = spine LEFT JOIN ops LEFT JOIN booked on (day, airport_name),
             zero-filled, ordered by (date, airport_name) through the days' slots

Seats and names only meet rows that are already grouped by their keys, so no
join is on a few hot codes and no size has to be checked while planning.  Rows
with a NULL airport name can never match the spine, so the bookings chain is of
inner joins.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.arith import minutes_from_seconds, percent_of, round2, truncate_to_long
from tarmac.functions.timeparts import day_string, hour_of_day, seconds_between
from tarmac.operators.joins import left_join, left_join_unique
from tarmac.operators.ordering import SLOT, in_day_order, slot_count
from tarmac.plans.checks import Checks, total
from tarmac.plans.blocks import ARRIVED, FARE_CLASSES, seat_capacity, segments_by_departure
from tarmac.plans.metrics import (
    average_delay,
    bookings_by_day_and_code,
    by_code,
    by_name,
    class_occupancy,
    completed_departures,
    daily_airtime,
    daily_bookings,
    daily_departures_by_day_period,
    daily_occupancy,
    daily_occupancy_by_fare_class,
    daily_revenue,
    delay_by_name,
    delay_sums,
    period_counts,
    seats_of_departures,
)
from tarmac.plans.spine import spine
from tarmac.schemas import MART_COLUMNS, PERIOD_COLUMNS
from tarmac.sources.tables import TableSource, load_domain_tables, load_table, overwrite_table


PASSENGERS = ["passengers", *[f"passengers_{c.lower()}" for c in FARE_CLASSES]]
OFFERED = ["seats", *[f"seats_{c.lower()}" for c in FARE_CLASSES]]


def departure_sums(departures: DataFrame, segments: DataFrame) -> DataFrame:
    """Sums of every departure-based metric by (day DATE, departure_airport, aircraft_code), in one pass.

    All of them add up, so sums of parts of the departures can be added.
    """
    deps = completed_departures(departures, require_id=False, require_arrived=False)
    ops = left_join_unique(
        deps, segments_by_departure(segments), "flight_id", ["scheduled_departure", "departure_airport", "aircraft_code"]
    )
    has_id = F.col("flight_id").isNotNull()
    arrived = has_id & (F.col("status") == F.lit(ARRIVED))
    return by_code(
        ops,
        F.sum(F.when(arrived, F.col("flight_revenue"))).alias("revenue"),
        F.sum(F.when(arrived, seconds_between(F.col("actual_arrival"), F.col("actual_departure")))).alias("seconds"),
        *period_counts(hour_of_day(F.col("scheduled_departure")), when=arrived),
        *delay_sums(deps),
        *[F.sum(F.when(has_id, F.col(c))).alias(c) for c in PASSENGERS],
        F.count_if(has_id).alias("departures"),
        more=("aircraft_code",),
    )


def metrics_of_sums(
    sums: DataFrame,
    seats: DataFrame,
    aircrafts_data: DataFrame,
    airports_data: DataFrame,
    lang: str | None = None,
    checks: Checks | None = None,
) -> DataFrame:
    """The departure-based metrics per (day, airport_name) of ``departure_sums``."""
    offered = seats_of_departures(sums, seat_capacity(seats, aircrafts_data), OFFERED)
    if checks is not None:
        offered = checks.watch(offered, completed=total("delayed"))
    named = by_name(offered, airports_data, lang)
    if checks is not None:
        unmatched = F.col("airport_name").isNull()
        named = checks.watch(named, named=total("delayed"), unmatched=total("delayed", when=unmatched))
    return named.select(
        "day",
        "airport_name",
        truncate_to_long(F.col("revenue")).alias("revenue"),
        round2(minutes_from_seconds(F.col("seconds"))).alias("airtime_minutes"),
        *PERIOD_COLUMNS.values(),
        average_delay(),
        F.coalesce(percent_of(F.col("passengers"), F.col("seats")), F.lit(0.0)).alias("avg_occupancy_percent"),
        *class_occupancy(
            {c: F.col(f"passengers_{c.lower()}") for c in FARE_CLASSES},
            {c: F.col(f"seats_{c.lower()}") for c in FARE_CLASSES},
        ),
    )


def departure_metrics(
    departures: DataFrame,
    segments: DataFrame,
    seats: DataFrame,
    aircrafts_data: DataFrame,
    airports_data: DataFrame,
    lang: str | None = None,
) -> DataFrame:
    """All departure-based metrics per (day DATE, airport_name) in one pass."""
    return metrics_of_sums(departure_sums(departures, segments), seats, aircrafts_data, airports_data, lang)


def finish(grid_joined: DataFrame) -> DataFrame:
    """Zero-fill numeric gaps and order like the reported table, by the grid's slots."""
    filled = grid_joined.select(*MART_COLUMNS, SLOT).na.fill(0)
    return in_day_order(filled, slot_count(grid_joined.sparkSession), "date", "airport_name")


def daily_airport_mart(
    aircrafts_data: DataFrame,
    airports_data: DataFrame,
    bookings: DataFrame,
    departures: DataFrame,
    seats: DataFrame,
    segments: DataFrame,
    tickets: DataFrame,
    lang: str | None = None,
    checks: Checks | None = None,
    segments_by_ticket: DataFrame | None = None,
) -> DataFrame:
    """The 14-column mart, one row per (date, airport_name) of the spine.

    ``checks`` counts what passes by.  ``segments_by_ticket`` is a copy of the
    segments' keys that is stored by ticket_no, if there is one.
    """
    sums = departure_sums(departures, segments)
    ops = metrics_of_sums(sums, seats, aircrafts_data, airports_data, lang, checks)
    own = segments if segments_by_ticket is None else segments_by_ticket
    booked = by_name(bookings_by_day_and_code(bookings, tickets, own, departures), airports_data, lang)
    keys = ["day", "airport_name"]
    joined = left_join(left_join(spine(airports_data, departures, bookings, lang), ops, keys), booked, keys)
    mart = finish(joined.withColumn("date", day_string(F.col("day"))))
    if checks is None:
        return mart
    return checks.watch(
        mart,
        rows=F.count(F.lit(1)),
        without_day=F.count_if(F.col("date").isNull()),
        without_name=F.count_if(F.col("airport_name") == ""),
    )


def assemble_mart_from_metrics(
    aircrafts_data: DataFrame,
    airports_data: DataFrame,
    bookings: DataFrame,
    departures: DataFrame,
    seats: DataFrame,
    segments: DataFrame,
    tickets: DataFrame,
    lang: str | None = None,
) -> DataFrame:
    """Same mart built from the seven standalone metrics (eight plans, seven
    joins).  Kept as the cross-check of the fused plan and for callers that
    want one metric family's exact standalone semantics."""
    keys = ["date", "airport_name"]
    parts = [
        daily_bookings(bookings, tickets, segments, departures, airports_data, lang).withColumnRenamed(
            "book_date", "date"
        ),
        daily_revenue(departures, airports_data, segments, lang),
        daily_airtime(departures, airports_data, lang),
        daily_departures_by_day_period(departures, airports_data, lang),
        delay_by_name(departures, airports_data, lang),
        daily_occupancy(departures, seats, segments, airports_data, lang),
        daily_occupancy_by_fare_class(seats, aircrafts_data, segments, departures, airports_data, lang),
    ]
    joined = spine(airports_data, departures, bookings, lang)
    joined = joined.select(day_string(F.col("day")).alias("date"), "airport_name", SLOT)
    for part in parts:
        joined = left_join(joined, part, keys)
    return finish(joined)


def run_job(
    spark: SparkSession,
    source: TableSource,
    sink: TableSource,
    table_name: str = "daily_airport_mart",
    lang: str | None = None,
    partition_by: list[str] | None = None,
    columns: Mapping[str, str] | None = None,
    checks: Checks | None = None,
) -> DataFrame:
    """Load the seven tables, compute the mart, overwrite ``table_name``
    (optionally partitioned, e.g. by ``date``).  Returns the written table
    read back.

    ``columns`` gives published names of columns that go by another one here;
    ``checks`` can be asked for its report afterwards.
    """
    t = load_domain_tables(spark, source)
    mart = daily_airport_mart(
        t["aircrafts_data"],
        t["airports_data"],
        t["bookings"],
        t["departures"],
        t["seats"],
        t["segments"],
        t["tickets"],
        lang=lang,
        checks=checks,
    )
    overwrite_table(mart.withColumnsRenamed(dict(columns or {})), table_name, sink, partition_by=partition_by)
    return load_table(spark, table_name, sink)


__all__ = [
    "PERIOD_COLUMNS",
    "assemble_mart_from_metrics",
    "daily_airport_mart",
    "departure_metrics",
    "departure_sums",
    "metrics_of_sums",
    "run_job",
]
