"""Per-departure and per-aircraft pre-aggregates shared by the metrics.

Both are computed once, in one aggregation pass each, so a fact row is read
once however many metrics use it.  Aggregate columns a caller does not use
are pruned by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.operators.relational import conditional_counts

# Fixed values -- the three fare classes reported, and the status that marks
# a completed departure.
FARE_CLASSES = ("Economy", "Business", "Comfort")
ARRIVED = "Arrived"


def _per_class(prefix: str) -> dict[str, Column]:
    return {f"{prefix}_{c.lower()}": F.col("fare_conditions") == F.lit(c) for c in FARE_CLASSES}


def segments_by_departure(segments: DataFrame) -> DataFrame:
    """One row per flight_id: revenue, passengers, passengers per class.

    Partial aggregation collapses a hot flight_id map-side, and the result is
    unique on flight_id, so joining it never fans out.
    """
    return segments.groupBy("flight_id").agg(
        F.sum("amount").alias("flight_revenue"),
        F.count(F.lit(1)).alias("passengers"),
        *conditional_counts(_per_class("passengers")),
    )


def seat_capacity(seats: DataFrame, aircrafts_data: DataFrame) -> DataFrame:
    """One row per aircraft_code found in ``seats``.

    ``seats`` counts every seat; ``seats_<class>`` counts a class only for
    aircraft listed in ``aircrafts_data`` (the per-class metric reports seats
    of the listed fleet only).  Callers join it to departures already counted
    by aircraft code, never to single departures.
    """
    per_aircraft = seats.groupBy("aircraft_code").agg(
        F.count(F.lit(1)).alias("seats"),
        *conditional_counts(_per_class("seats")),
    )
    fleet = aircrafts_data.select("aircraft_code").distinct().withColumn("in_fleet", F.lit(True))
    listed = per_aircraft.join(fleet, "aircraft_code", "left")
    in_fleet = F.coalesce(F.col("in_fleet"), F.lit(False))
    return listed.select(
        "aircraft_code",
        "seats",
        *[
            F.when(in_fleet, F.col(f"seats_{c.lower()}")).otherwise(F.lit(0)).alias(f"seats_{c.lower()}")
            for c in FARE_CLASSES
        ],
    )
