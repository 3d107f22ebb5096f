"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver tables under ``sf_dir`` through the binding; all
but the four on airport names alone (``nation`` and ``region``, 25 rows at any
scale) grow with them.  ``tarmac.oracle.ORACLE_SQL`` holds the DuckDB
counterpart of each name that is expressible in SQL.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.plans.airports import clean_airports
from tarmac.plans.incremental import refresh, stored_mart
from tarmac.plans.mart import assemble_mart_from_metrics, daily_airport_mart
from tarmac.plans.metrics import (
    daily_airtime,
    daily_bookings,
    daily_departure_delay,
    daily_departures_by_day_period,
    daily_occupancy,
    daily_occupancy_by_fare_class,
    daily_revenue,
)
from tarmac.plans.spine import date_airport_spine
from tarmac.schemas import SEGMENTS
from tarmac.session import checkpoint_dir
from tarmac.sources.binding import bind_domain_tables
from tarmac.sources.dump import dump_source, write_dump
from tarmac.sources.tables import TableSource, load_table, overwrite_table

Query = Callable[[SparkSession, str], DataFrame]


def _mart_args(t: dict[str, DataFrame]) -> tuple[DataFrame, ...]:
    return (
        t["aircrafts_data"],
        t["airports_data"],
        t["bookings"],
        t["departures"],
        t["seats"],
        t["segments"],
        t["tickets"],
    )


def q_airports_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = bind_domain_tables(spark, sf_dir)
    a = clean_airports(t["airports_data"])
    return a.select(
        "airport_code",
        F.col("coordinates.lon").alias("lon"),
        F.col("coordinates.lat").alias("lat"),
        "timezone",
        "airport_name",
        "city_name",
    )


def q_date_airport_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = bind_domain_tables(spark, sf_dir)
    return date_airport_spine(t["airports_data"], t["departures"], t["bookings"])


def q_cross_join_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3, the product itself: every scheduled departure day with every airport code."""
    t = bind_domain_tables(spark, sf_dir)
    days = t["departures"].select(F.to_date("scheduled_departure").alias("day")).distinct()
    return days.crossJoin(t["airports_data"].select("airport_code"))


def q_daily_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = bind_domain_tables(spark, sf_dir)
    return daily_bookings(t["bookings"], t["tickets"], t["segments"], t["departures"], t["airports_data"])


def q_daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = bind_domain_tables(spark, sf_dir)
    return daily_revenue(t["departures"], t["airports_data"], t["segments"])


def q_daily_airtime(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = bind_domain_tables(spark, sf_dir)
    return daily_airtime(t["departures"], t["airports_data"])


def q_daily_departures_by_day_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = bind_domain_tables(spark, sf_dir)
    return daily_departures_by_day_period(t["departures"], t["airports_data"])


def q_daily_departure_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = bind_domain_tables(spark, sf_dir)
    return daily_departure_delay(t["departures"], t["airports_data"])


def q_daily_occupancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = bind_domain_tables(spark, sf_dir)
    return daily_occupancy(t["departures"], t["seats"], t["segments"], t["airports_data"])


def q_daily_occupancy_by_fare_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = bind_domain_tables(spark, sf_dir)
    return daily_occupancy_by_fare_class(
        t["seats"], t["aircrafts_data"], t["segments"], t["departures"], t["airports_data"]
    )


def q_daily_airport_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_airport_mart(*_mart_args(bind_domain_tables(spark, sf_dir)))


def q_daily_airport_mart_assembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble_mart_from_metrics(*_mart_args(bind_domain_tables(spark, sf_dir)))


def _new_folder(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"


def q_scan_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: the ticket segments read from a plain-text dump, which is written from
    the given tables first."""
    path = _new_folder(spark)
    write_dump(bind_domain_tables(spark, sf_dir)["segments"], path, "segments")
    rows = load_table(spark, "segments", dump_source(spark, path), SEGMENTS)
    return rows.withColumn("amount", F.col("amount").cast("double"))


def q_staged_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 and S6: the revenue written by the staged sink, then read back."""
    folder = _new_folder(spark)
    sink = TableSource(format="staged", location=folder + "/{name}", options={"staging": folder + "/staging"})
    overwrite_table(q_daily_revenue(spark, sf_dir), "revenue", sink)
    return load_table(spark, "revenue", sink)


def q_versioned_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5: the airtime by year, of which the even years are then overwritten with
    their own rows doubled, read from the same table."""
    sink = TableSource(format="versioned", location=_new_folder(spark) + "/{name}")
    airtime = q_daily_airtime(spark, sf_dir).withColumn("year", F.substring("date", 1, 4))
    overwrite_table(airtime, "airtime", sink, ["year"])
    even = load_table(spark, "airtime", sink).filter("CAST(year AS INT) % 2 = 0").withColumn("airtime_minutes", F.col("airtime_minutes") * 2)
    overwrite_table(even, "airtime", sink, ["year"], dynamic=True)
    return load_table(spark, "airtime", sink)


def q_incremental_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C11: the mart of stored sums, which were computed for the days before 1996
    first and refreshed with the later ones."""
    t, root = bind_domain_tables(spark, sf_dir), _new_folder(spark)
    refresh(spark, t, root, [(None, date(1995, 12, 31)), None])
    refresh(spark, t, root, [(date(1996, 1, 1), None)])
    return stored_mart(spark, root, t["aircrafts_data"], t["airports_data"], t["seats"])


def q_overwrite_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart written as a parquet table in the shared checkpoint folder,
    then read back (the sink of the batch job)."""
    mart = q_daily_airport_mart(spark, sf_dir)
    sink = TableSource(location=_new_folder(spark) + "/{name}")
    overwrite_table(mart, "daily_airport_mart", sink)
    return spark.read.parquet(sink.path("daily_airport_mart"))


BUSINESS_QUERIES: dict[str, Query] = {
    "airports_clean": q_airports_clean,
    "date_airport_spine": q_date_airport_spine,
    "cross_join_spine": q_cross_join_spine,
    "daily_bookings": q_daily_bookings,
    "daily_revenue": q_daily_revenue,
    "daily_airtime": q_daily_airtime,
    "daily_departures_by_day_period": q_daily_departures_by_day_period,
    "daily_departure_delay": q_daily_departure_delay,
    "daily_occupancy": q_daily_occupancy,
    "daily_occupancy_by_fare_class": q_daily_occupancy_by_fare_class,
    "daily_airport_mart": q_daily_airport_mart,
    "daily_airport_mart_assembled": q_daily_airport_mart_assembled,
    "incremental_mart": q_incremental_mart,
    "overwrite_table": q_overwrite_table,
    "scan_dump": q_scan_dump,
    "staged_write": q_staged_write,
    "versioned_overwrite": q_versioned_overwrite,
}


def all_queries() -> dict[str, Query]:
    from tarmac.plans.relational import RELATIONAL_QUERIES

    return {**BUSINESS_QUERIES, **RELATIONAL_QUERIES}
