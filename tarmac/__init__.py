"""tarmac: a daily per-airport airline mart built from Spark DataFrame operators.

Every public function takes DataFrames (and plain parameters) and returns a
lazily planned DataFrame; nothing is collected to the driver.  See README.md.
"""

from tarmac.plans.airports import clean_airports
from tarmac.plans.mart import assemble_mart_from_metrics, daily_airport_mart, run_job
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
from tarmac.session import build_session, checkpoint_dir

__all__ = [
    "assemble_mart_from_metrics",
    "build_session",
    "checkpoint_dir",
    "clean_airports",
    "daily_airport_mart",
    "daily_airtime",
    "daily_bookings",
    "daily_departure_delay",
    "daily_departures_by_day_period",
    "daily_occupancy",
    "daily_occupancy_by_fare_class",
    "daily_revenue",
    "date_airport_spine",
    "run_job",
]
