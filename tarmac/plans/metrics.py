"""The seven daily per-airport metrics, each usable on its own.

Every metric is grouped by (day of scheduled departure, airport name) -- the
bookings metric by day of booking, the delay metric by airport code -- and
returns (date 'yyyy-MM-dd', airport_name, value...).  Departures whose airport
code has no airport give a NULL name group, kept here and dropped by the mart
(NULL never joins).

Sums are taken by (day, airport code) first, and where seats count by aircraft
code as well; only these few rows meet the airport and seat tables, so a busy
airport or aircraft type is never a hot join key.

Row filters per metric (a departure is "completed" when both actual times are
present):

  metric            flight_id not NULL  completed  status = Arrived
  revenue, airtime,        yes             yes          yes
  day periods
  delay                    no              yes          no
  occupancy (both)         yes             yes          no
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.arith import minutes_from_seconds, percent_of, round2, truncate_to_long
from tarmac.functions.timeparts import DAY_PERIODS, day_of, day_string, hour_of_day, seconds_between
from tarmac.operators.joins import left_join
from tarmac.operators.relational import not_null, range_predicate
from tarmac.plans.airports import airport_names
from tarmac.plans.blocks import ARRIVED, FARE_CLASSES, seat_capacity, segments_by_departure
from tarmac.schemas import PERIOD_COLUMNS

COMPLETED = ("actual_departure", "actual_arrival")


def completed_departures(departures: DataFrame, require_id: bool, require_arrived: bool) -> DataFrame:
    """Departures with both actual times, optionally with an id and Arrived.
    Written as IS NOT NULL / = predicates so they reach the parquet scan."""
    cond = not_null(COMPLETED)
    if require_id:
        cond = cond & F.col("flight_id").isNotNull()
    if require_arrived:
        cond = cond & (F.col("status") == F.lit(ARRIVED))
    return departures.filter(cond)


def _day_key() -> Column:
    return day_of(F.col("scheduled_departure")).alias("day")


def _publish(df: DataFrame, *values: str) -> DataFrame:
    return df.select(day_string(F.col("day")).alias("date"), "airport_name", *values)


def by_code(departures: DataFrame, *sums: Column, more: tuple[str, ...] = ()) -> DataFrame:
    """Sums by (day, departure_airport and ``more``)."""
    return departures.groupBy(_day_key(), "departure_airport", *more).agg(*sums)


def by_name(coded: DataFrame, airports_data: DataFrame, lang: str | None = None) -> DataFrame:
    """Sums by (day, departure_airport) added up by (day, airport_name)."""
    values = [c for c in coded.columns if c not in ("day", "departure_airport", "airport_code")]
    names = airport_names(airports_data, lang)
    named = coded.join(names, coded["departure_airport"] == names["airport_code"], "left")
    return named.groupBy("day", "airport_name").agg(*[F.sum(c).alias(c) for c in values])


def delay_sums(deps: DataFrame) -> list[Column]:
    """Seconds and number of departures whose delay counts."""
    delay = seconds_between(F.col("actual_departure"), F.col("scheduled_departure"))
    return [F.sum(delay).alias("delay_seconds"), F.count(delay).alias("delayed")]


def average_delay() -> Column:
    return round2(F.try_divide(F.col("delay_seconds"), F.col("delayed"))).alias("avg_delay_seconds")


def seats_of_departures(coded: DataFrame, capacity: DataFrame, columns: list[str]) -> DataFrame:
    """Sums by (day, departure_airport, aircraft_code) with ``departures`` turned
    into offered seats: each seat column times the departures of its aircraft."""
    joined = left_join(coded, capacity.select("aircraft_code", *columns), "aircraft_code")
    offered = {c: F.col(c) * F.col("departures") for c in columns}
    values = [c for c in coded.columns if c not in ("day", "departure_airport", "aircraft_code", "departures")]
    return joined.withColumns(offered).groupBy("day", "departure_airport").agg(*[F.sum(c).alias(c) for c in [*values, *columns]])


def period_counts(hour: Column, when: Column | None = None) -> list[Column]:
    """count_if per part of day (one pass; no pivot shuffle)."""
    cols = []
    for label, start, end in DAY_PERIODS:
        cond = range_predicate(hour, start, end)
        if when is not None:
            cond = cond & when
        cols.append(F.count_if(cond).alias(PERIOD_COLUMNS[label]))
    return cols


def class_occupancy(passengers: dict[str, Column], seats: dict[str, Column]) -> list[Column]:
    return [
        F.coalesce(percent_of(passengers[c], seats[c]), F.lit(0.0)).alias(f"avg_occupancy_{c.lower()}")
        for c in FARE_CLASSES
    ]


# --------------------------------------------------------------------- C3
def daily_bookings(
    bookings: DataFrame,
    tickets: DataFrame,
    segments: DataFrame,
    departures: DataFrame,
    airports_data: DataFrame,
    lang: str | None = None,
) -> DataFrame:
    """Ticket segments per (booking day, departure airport name).

    Counts the rows of bookings LEFT JOIN tickets LEFT JOIN segments LEFT JOIN
    departures LEFT JOIN airports -- segments, not distinct bookings; a
    booking without ticket or a ticket without segment counts once under a
    NULL name.  Output: (book_date, airport_name, bookings).
    """
    return bookings_by_day(bookings, tickets, segments, departures, airports_data, lang=lang).select(
        day_string(F.col("day")).alias("book_date"), "airport_name", "bookings"
    )


def bookings_by_day(
    bookings: DataFrame,
    tickets: DataFrame,
    segments: DataFrame,
    departures: DataFrame,
    airports_data: DataFrame,
    lang: str | None = None,
) -> DataFrame:
    """(day DATE, airport_name, bookings) -- see ``daily_bookings``.

    Counts travel instead of rows: a ticket stands for the number of its
    segments by departure airport code, or for 1 without any, and a booking for
    the sum of its tickets', or for 1.  Each table is read once, every count is
    summed map-side before it is shuffled, so a hot ticket or booking is a few
    rows on the right of its join, and no join gives out more rows than its left
    side times the codes of one ticket or booking.  A hot or missing key on the
    left is split by AQE.
    """
    one = F.lit(1).cast("long")
    coded = left_join(
        segments.filter(F.col("ticket_no").isNotNull()).select("ticket_no", "flight_id"),
        departures.select("flight_id", "departure_airport"),
        "flight_id",
    )
    of_ticket = coded.groupBy("ticket_no", "departure_airport").agg(F.count(F.lit(1)).alias("n"))
    ticketed = left_join(tickets.filter(F.col("book_ref").isNotNull()).select("book_ref", "ticket_no"), of_ticket, "ticket_no")
    of_booking = ticketed.groupBy("book_ref", "departure_airport").agg(F.sum(F.coalesce("n", one)).alias("n"))
    booked = left_join(bookings.select("book_ref", day_of(F.col("book_date")).alias("day")), of_booking, "book_ref")
    of_day = booked.groupBy("day", "departure_airport").agg(F.sum(F.coalesce("n", one)).alias("bookings"))
    return by_name(of_day, airports_data, lang)


def bookings_by_day_and_code(bookings: DataFrame, tickets: DataFrame, segments: DataFrame, departures: DataFrame) -> DataFrame:
    """(day DATE, departure_airport, bookings) of the segments that have a booking and a departure.

    For results in which rows without an airport name don't count: inner joins
    (AQE splits a hot key on either side) and one shuffle of segments as they
    are; they are counted by (flight_id, day) before departures are joined, so
    a departure's many passengers are one row a day.
    """
    booked = bookings.select("book_ref", day_of(F.col("book_date")).alias("day"))
    ticketed = booked.join(tickets.select("book_ref", "ticket_no"), "book_ref")
    carried = ticketed.select("ticket_no", "day").join(segments.select("ticket_no", "flight_id"), "ticket_no")
    counted = carried.groupBy("flight_id", "day").agg(F.count(F.lit(1)).alias("bookings"))
    coded = counted.join(departures.select("flight_id", "departure_airport"), "flight_id")
    return coded.groupBy("day", "departure_airport").agg(F.sum("bookings").alias("bookings"))


# --------------------------------------------------------------------- C4
def daily_revenue(
    departures: DataFrame, airports_data: DataFrame, segments: DataFrame, lang: str | None = None
) -> DataFrame:
    """Sum of segment amounts of Arrived departures, truncated to bigint.
    Output: (date, airport_name, revenue)."""
    deps = completed_departures(departures, require_id=True, require_arrived=True)
    per_departure = segments_by_departure(segments).select("flight_id", "flight_revenue")
    joined = left_join(deps, per_departure, "flight_id")
    agg = by_name(by_code(joined, F.sum("flight_revenue").alias("revenue")), airports_data, lang)
    return _publish(agg.withColumn("revenue", truncate_to_long(F.col("revenue"))), "revenue")


# --------------------------------------------------------------------- C5
def daily_airtime(departures: DataFrame, airports_data: DataFrame, lang: str | None = None) -> DataFrame:
    """Minutes between actual departure and arrival of Arrived departures,
    summed, /60, rounded to 2 dp.  Output: (date, airport_name, airtime_minutes)."""
    deps = completed_departures(departures, require_id=True, require_arrived=True)
    seconds = F.sum(seconds_between(F.col("actual_arrival"), F.col("actual_departure"))).alias("seconds")
    agg = by_name(by_code(deps, seconds), airports_data, lang)
    return _publish(agg.withColumn("airtime_minutes", round2(minutes_from_seconds(F.col("seconds")))), "airtime_minutes")


# --------------------------------------------------------------------- C6
def daily_departures_by_day_period(
    departures: DataFrame, airports_data: DataFrame, lang: str | None = None
) -> DataFrame:
    """Arrived departures per part of the day of the scheduled departure.
    Output: (date, airport_name, one column a part of the day)."""
    deps = completed_departures(departures, require_id=True, require_arrived=True)
    agg = by_name(by_code(deps, *period_counts(hour_of_day(F.col("scheduled_departure")))), airports_data, lang)
    return _publish(agg, *PERIOD_COLUMNS.values())


# --------------------------------------------------------------------- C7
def daily_departure_delay(departures: DataFrame, airports_data: DataFrame, lang: str | None = None) -> DataFrame:
    """Average seconds from scheduled to actual departure of completed
    departures of any status (early departures count negative), 2 dp, one row
    a day and airport CODE, with the airport's name: two codes that share a
    name give two rows, and each unmatched code one with a NULL name.
    Output: (date, airport_name, avg_delay_seconds)."""
    deps = completed_departures(departures, require_id=False, require_arrived=False)
    coded = by_code(deps, *delay_sums(deps))
    names = airport_names(airports_data, lang)
    named = coded.join(names, coded["departure_airport"] == names["airport_code"], "left")
    return _publish(named.withColumn("avg_delay_seconds", average_delay()), "avg_delay_seconds")


def delay_by_name(departures: DataFrame, airports_data: DataFrame, lang: str | None = None) -> DataFrame:
    """The mart's delay: as ``daily_departure_delay``, but the sums and counts of
    codes that share a name are added up first."""
    deps = completed_departures(departures, require_id=False, require_arrived=False)
    agg = by_name(by_code(deps, *delay_sums(deps)), airports_data, lang)
    return _publish(agg.withColumn("avg_delay_seconds", average_delay()), "avg_delay_seconds")


# --------------------------------------------------------------------- C8
def daily_occupancy(
    departures: DataFrame,
    seats: DataFrame,
    segments: DataFrame,
    airports_data: DataFrame,
    lang: str | None = None,
) -> DataFrame:
    """round(sum(passengers) / sum(seats) * 100, 2) over completed departures
    with an id -- a ratio of sums.  Output: (date, airport_name,
    avg_occupancy_percent), NULL -> 0."""
    deps = completed_departures(departures, require_id=True, require_arrived=False)
    pax = segments_by_departure(segments).select("flight_id", "passengers")
    coded = by_code(
        left_join(deps, pax, "flight_id"),
        F.sum("passengers").alias("passengers"),
        F.count(F.lit(1)).alias("departures"),
        more=("aircraft_code",),
    )
    capacity = seats.groupBy("aircraft_code").agg(F.count(F.lit(1)).alias("seats"))
    agg = by_name(seats_of_departures(coded, capacity, ["seats"]), airports_data, lang)
    percent = F.coalesce(percent_of(F.col("passengers"), F.col("seats")), F.lit(0.0))
    return _publish(agg.withColumn("avg_occupancy_percent", percent), "avg_occupancy_percent")


# --------------------------------------------------------------------- C9
def daily_occupancy_by_fare_class(
    seats: DataFrame,
    aircrafts_data: DataFrame,
    segments: DataFrame,
    departures: DataFrame,
    airports_data: DataFrame,
    lang: str | None = None,
) -> DataFrame:
    """Occupancy per fare class, ratio of sums; seats only of aircraft listed
    in ``aircrafts_data``; a class with no seats gives 0 (no ANSI error).
    Output: (date, airport_name, avg_occupancy_economy,
    avg_occupancy_business, avg_occupancy_comfort)."""
    deps = completed_departures(departures, require_id=True, require_arrived=False)
    passengers = [f"passengers_{c.lower()}" for c in FARE_CLASSES]
    offered = [f"seats_{c.lower()}" for c in FARE_CLASSES]
    pax = segments_by_departure(segments).select("flight_id", *passengers)
    coded = by_code(
        left_join(deps, pax, "flight_id"),
        *[F.sum(c).alias(c) for c in passengers],
        F.count(F.lit(1)).alias("departures"),
        more=("aircraft_code",),
    )
    agg = by_name(seats_of_departures(coded, seat_capacity(seats, aircrafts_data), offered), airports_data, lang)
    named = agg.select("day", "airport_name", *class_occupancy(
        {c: F.col(f"passengers_{c.lower()}") for c in FARE_CLASSES}, {c: F.col(f"seats_{c.lower()}") for c in FARE_CLASSES}
    ))
    return _publish(named, *[f"avg_occupancy_{c.lower()}" for c in FARE_CLASSES])
