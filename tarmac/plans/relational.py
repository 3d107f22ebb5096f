"""Queries that exercise the small relational operators one at a time.

Each runs over the whole bound tables (see ``tarmac.sources.binding``) and is
same operators; these queries pin each one down against the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.arith import minutes_from_seconds, percent_of, round2, truncate_to_long
from tarmac.functions.names import (
    AIRPORT_NAME_PATTERN,
    CITY_NAME_PATTERN,
    json_to_map,
    leading_words,
    map_values_joined,
)
from tarmac.functions.timeparts import DAY_PERIODS, day_period, day_string, hour_of_day, seconds_between
from tarmac.operators.joins import left_join, left_join_few_codes, left_join_unique, split_left_join
from tarmac.operators.relational import (
    conditional_counts,
    drop_null_rows,
    fill_null_numeric,
    filter_equals,
    range_predicate,
    union_distinct,
)
from tarmac.operators.ordering import SLOT, in_day_order, slot_count, with_slots
from tarmac.plans.airports import airport_names
from tarmac.plans.blocks import ARRIVED, FARE_CLASSES, segments_by_departure
from tarmac.plans.metrics import COMPLETED, by_code, by_name, completed_departures, daily_airtime, daily_revenue, seats_of_departures
from tarmac.schemas import PERIOD_COLUMNS
from tarmac.sources.binding import bind_domain_tables
from tarmac.sources.tables import TableSource, load_table


def _t(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return bind_domain_tables(spark, sf_dir)


# ------------------------------------------------------------ scans (S1)
def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1: named-table scan through the configurable source, all columns."""
    source = TableSource(location=f"{sf_dir.rstrip('/')}/{{name}}.parquet")
    return load_table(spark, "orders", source)


# ------------------------------------------------------ projections (P)
def project_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir)["departures"].select(
        "flight_id", "flight_no", "departure_airport", "arrival_airport", "status", "aircraft_code"
    )


def project_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    deps = completed_departures(_t(spark, sf_dir)["departures"], require_id=True, require_arrived=False)
    return deps.select("flight_id", day_string(F.col("scheduled_departure")).alias("date"), "departure_airport")


def derive_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    departures = _t(spark, sf_dir)["departures"]
    return departures.withColumns(
        {
            "delay_seconds": seconds_between(F.col("actual_departure"), F.col("scheduled_departure")),
            "airtime_seconds": seconds_between(F.col("actual_arrival"), F.col("actual_departure")),
        }
    ).select("flight_id", "delay_seconds", "airtime_seconds")


def rename_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir)["seats"].withColumnsRenamed({"aircraft_code": "code", "fare_conditions": "fare_class"})


def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir)["tickets"].drop("passenger_name", "contact_data")


# ---------------------------------------------------------- filters (F)
def q_filter_equals(spark: SparkSession, sf_dir: str) -> DataFrame:
    departures = _t(spark, sf_dir)["departures"]
    return filter_equals(departures, "status", ARRIVED).select("flight_id", "status", "departure_airport")


def q_drop_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    departures = _t(spark, sf_dir)["departures"]
    return drop_null_rows(departures, COMPLETED).select("flight_id", *COMPLETED)


def q_fill_null_all_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_null_numeric(pivot_sum(spark, sf_dir), 0)


def q_fill_null_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-class seat counts of every listed aircraft; classes an aircraft
    lacks (or aircraft without seats) become 0."""
    t = _t(spark, sf_dir)
    per_class = {f"seats_{c.lower()}": F.col("fare_conditions") == F.lit(c) for c in FARE_CLASSES}
    counts = t["seats"].groupBy("aircraft_code").agg(*conditional_counts(per_class))
    fleet = t["aircrafts_data"].select("aircraft_code").distinct()
    return fill_null_numeric(left_join(fleet, counts, "aircraft_code"), 0, subset=list(per_class))


def q_range_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    departures = _t(spark, sf_dir)["departures"]
    hour = hour_of_day(F.col("scheduled_departure"))
    return departures.filter(range_predicate(hour, 6, 12)).select("flight_id", hour.cast("long").alias("hour"))


# ------------------------------------------------------------ joins (J)
def left_join_single_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    seg = t["segments"].select("ticket_no", "flight_id", "fare_conditions")
    dep = t["departures"].select("flight_id", "departure_airport", "status")
    return left_join_unique(seg, dep, "flight_id", ["ticket_no"])


def left_join_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    revenue = daily_revenue(t["departures"], t["airports_data"], t["segments"])
    airtime = daily_airtime(t["departures"], t["airports_data"])
    return left_join(revenue, airtime, ["date", "airport_name"])


def star_join_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bookings -> tickets -> segments -> departures -> airports, row level."""
    t = _t(spark, sf_dir)
    ticketed, without_ticket = split_left_join(
        t["bookings"].select("book_ref"), t["tickets"].select("book_ref", "ticket_no"), "book_ref"
    )
    carried, without_segment = split_left_join(ticketed, t["segments"].select("ticket_no", "flight_id"), "ticket_no")
    # departures are unique per flight_id, names per code; both may be missing
    coded = left_join_unique(carried, t["departures"].select("flight_id", "departure_airport"), "flight_id", ["ticket_no"])
    names = airport_names(t["airports_data"]).withColumnRenamed("airport_code", "departure_airport")
    chain = left_join_few_codes(coded, names, "departure_airport", ["ticket_no"])
    # rows without a match pass by the later joins
    none = F.lit(None).cast("string")
    rest = without_segment.select("book_ref", "ticket_no").unionByName(
        without_ticket.select("book_ref", none.alias("ticket_no"))
    ).select("book_ref", "ticket_no", F.lit(None).cast("long").alias("flight_id"), none.alias("airport_name"))
    return chain.select("book_ref", "ticket_no", "flight_id", "airport_name").unionByName(rest)


def aggregate_then_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    deps = completed_departures(t["departures"], require_id=True, require_arrived=False)
    per_departure = segments_by_departure(t["segments"]).select("flight_id", "flight_revenue")
    return left_join(deps.select("flight_id", "departure_airport"), per_departure, "flight_id").select(
        "flight_id", "departure_airport", F.col("flight_revenue").cast("double").alias("flight_revenue")
    )


# ------------------------------------------------------- aggregates (A)
def group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir)["seats"].groupBy("aircraft_code").agg(F.count(F.lit(1)).alias("seats"))


def group_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    seg = _t(spark, sf_dir)["segments"]
    return seg.groupBy("flight_id").agg(F.sum("amount").cast("double").alias("flight_revenue"))


def group_multi_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passengers and seats per (date, airport) in one aggregation."""
    t = _t(spark, sf_dir)
    deps = completed_departures(t["departures"], require_id=True, require_arrived=False)
    pax = segments_by_departure(t["segments"]).select("flight_id", "passengers")
    cap = t["seats"].groupBy("aircraft_code").agg(F.count(F.lit(1)).alias("seats"))
    coded = by_code(
        left_join(deps, pax, "flight_id"),
        F.sum("passengers").alias("passengers"),
        F.count(F.lit(1)).alias("departures"),
        more=("aircraft_code",),
    )
    sums = by_name(seats_of_departures(coded, cap, ["seats"]), t["airports_data"])
    return sums.select(
        day_string(F.col("day")).alias("date"), "airport_name", "passengers", F.col("seats").alias("seats_available")
    )


def group_avg_rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average departure delay per (airport code, day), 2 dp."""
    deps = completed_departures(_t(spark, sf_dir)["departures"], require_id=False, require_arrived=False)
    return deps.groupBy("departure_airport", day_string(F.col("scheduled_departure")).alias("date")).agg(
        round2(F.avg(seconds_between(F.col("actual_departure"), F.col("scheduled_departure")))).alias(
            "avg_delay_seconds"
        )
    )


def two_level_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue summed per departure, then per (day, airport code)."""
    t = _t(spark, sf_dir)
    deps = completed_departures(t["departures"], require_id=True, require_arrived=True)
    per_departure = t["segments"].groupBy("flight_id").agg(F.sum("amount").alias("flight_revenue"))
    j = left_join(deps, per_departure, "flight_id")
    return j.groupBy(day_string(F.col("scheduled_departure")).alias("date"), "departure_airport").agg(
        F.sum("flight_revenue").cast("double").alias("revenue")
    )


def pivot_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completed Arrived departures counted per (day, airport, part of day),
    then pivoted on the fixed list of parts with sum (absent cells NULL)."""
    t = _t(spark, sf_dir)
    deps = completed_departures(t["departures"], require_id=True, require_arrived=True)
    coded = deps.groupBy(
        day_string(F.col("scheduled_departure")).alias("date"),
        "departure_airport",
        day_period(hour_of_day(F.col("scheduled_departure"))).alias("day_period"),
    ).count()
    names = airport_names(t["airports_data"])
    counted = coded.join(names, coded["departure_airport"] == names["airport_code"], "left")
    labels = [label for label, _, _ in DAY_PERIODS]
    pivoted = counted.groupBy("date", "airport_name").pivot("day_period", labels).sum("count")
    return pivoted.withColumnsRenamed(PERIOD_COLUMNS)


def conditional_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    seg = _t(spark, sf_dir)["segments"]
    per_class = {f"passengers_{c.lower()}": F.col("fare_conditions") == F.lit(c) for c in FARE_CLASSES}
    return seg.groupBy("flight_id").agg(*conditional_counts(per_class))


def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir)["departures"].select("departure_airport", "aircraft_code").distinct()


def ratio_of_sums_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occupancy per airport name over all days: round(sum(pax)/sum(seats)*100, 2)."""
    multi = group_multi_sum(spark, sf_dir)
    return multi.groupBy("airport_name").agg(
        F.coalesce(percent_of(F.sum("passengers"), F.sum("seats_available")), F.lit(0.0)).alias(
            "occupancy_percent"
        )
    )


# -------------------------------------------------- sort and sets (O, U)
def order_by_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The airtime in order of date and name, NULL first; the days give the bounds of the ranges."""
    t = _t(spark, sf_dir)
    slots = slot_count(spark)
    days = t["departures"].select(day_string(F.col("scheduled_departure")).alias("date")).distinct()
    dealt = left_join(daily_airtime(t["departures"], t["airports_data"]), with_slots(days, slots, "date"), "date")
    return in_day_order(dealt.fillna(0, [SLOT]), slots, "date", "airport_name")


def q_union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    flight_days = t["departures"].select(day_string(F.col("scheduled_departure")).alias("date"))
    book_days = t["bookings"].select(day_string(F.col("book_date")).alias("date"))
    return union_distinct(flight_days, book_days)


# -------------------------------------------------- scalar functions (E)
def q_json_to_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _t(spark, sf_dir)["airports_data"]
    m = json_to_map(F.col("airport_name"))
    return a.select(
        "airport_code",
        F.size(m).cast("long").alias("n_names"),
        F.try_element_at(m, F.lit("en")).alias("name_en"),
        F.try_element_at(m, F.lit("ru")).alias("name_ru"),
    )


def q_map_values_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _t(spark, sf_dir)["airports_data"]
    return a.select("airport_code", map_values_joined(json_to_map(F.col("city"))).alias("city_names"))


def q_regex_leading_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _t(spark, sf_dir)["airports_data"]
    return a.select(
        "airport_code",
        leading_words(map_values_joined(json_to_map(F.col("airport_name"))), AIRPORT_NAME_PATTERN).alias(
            "airport_words"
        ),
        leading_words(map_values_joined(json_to_map(F.col("city"))), CITY_NAME_PATTERN).alias("city_words"),
    )


def q_day_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _t(spark, sf_dir)["departures"]
    return f.select("flight_id", day_string(F.col("scheduled_departure")).alias("date"))


def q_timestamp_diff_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    deps = completed_departures(_t(spark, sf_dir)["departures"], require_id=False, require_arrived=False)
    return deps.select(
        "flight_id", seconds_between(F.col("actual_arrival"), F.col("actual_departure")).alias("airtime_seconds")
    )


def q_hour_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _t(spark, sf_dir)["departures"]
    return f.select("flight_id", hour_of_day(F.col("scheduled_departure")).cast("long").alias("hour"))


def q_day_period_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _t(spark, sf_dir)["departures"]
    return f.select("flight_id", day_period(hour_of_day(F.col("scheduled_departure"))).alias("day_period"))


def q_cast_truncate_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    seg = _t(spark, sf_dir)["segments"]
    return seg.groupBy("flight_id").agg(truncate_to_long(F.sum("amount")).alias("revenue"))


def q_round_half_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occupancy percent of each completed departure, 2 dp."""
    t = _t(spark, sf_dir)
    deps = completed_departures(t["departures"], require_id=True, require_arrived=False)
    pax = segments_by_departure(t["segments"]).select("flight_id", "passengers")
    cap = t["seats"].groupBy("aircraft_code").agg(F.count(F.lit(1)).alias("seats"))
    j = left_join_few_codes(left_join(deps, pax, "flight_id"), cap, "aircraft_code", ["flight_id"])
    return j.select("flight_id", percent_of(F.col("passengers"), F.col("seats")).alias("occupancy_percent"))


def q_minutes_from_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    deps = completed_departures(_t(spark, sf_dir)["departures"], require_id=True, require_arrived=True)
    secs = seconds_between(F.col("actual_arrival"), F.col("actual_departure"))
    return deps.select("flight_id", minutes_from_seconds(secs).alias("airtime_minutes"))


RELATIONAL_QUERIES = {
    "scan_table": scan_table,
    "project_columns": project_columns,
    "project_expression": project_expression,
    "derive_column": derive_column,
    "rename_columns": rename_columns,
    "drop_columns": drop_columns,
    "filter_equals": q_filter_equals,
    "drop_null_rows": q_drop_null_rows,
    "fill_null_all_numeric": q_fill_null_all_numeric,
    "fill_null_subset": q_fill_null_subset,
    "range_predicate": q_range_predicate,
    "left_join_single_key": left_join_single_key,
    "left_join_composite_key": left_join_composite_key,
    "star_join_chain": star_join_chain,
    "aggregate_then_join": aggregate_then_join,
    "group_count": group_count,
    "group_sum": group_sum,
    "group_multi_sum": group_multi_sum,
    "group_avg_rounded": group_avg_rounded,
    "two_level_sum": two_level_sum,
    "pivot_sum": pivot_sum,
    "conditional_count": conditional_count,
    "distinct_rows": distinct_rows,
    "ratio_of_sums_percent": ratio_of_sums_percent,
    "order_by_two_keys": order_by_two_keys,
    "union_distinct": q_union_distinct,
    "json_to_map": q_json_to_map,
    "map_values_joined": q_map_values_joined,
    "regex_leading_words": q_regex_leading_words,
    "day_string": q_day_string,
    "timestamp_diff_seconds": q_timestamp_diff_seconds,
    "hour_of_day": q_hour_of_day,
    "day_period_bucket": q_day_period_bucket,
    "cast_truncate_long": q_cast_truncate_long,
    "round_half_up": q_round_half_up,
    "minutes_from_seconds": q_minutes_from_seconds,
}

__all__ = ["RELATIONAL_QUERIES"]
