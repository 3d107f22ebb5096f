"""A small airline data set worked out by hand, with declared schemas."""

from datetime import datetime
from decimal import Decimal

from tarmac import schemas


def ts(text):
    return datetime.strptime(text, "%Y-%m-%d %H:%M") if text else None


def golden_tables(spark):
    """Three departures of two airports on two days.

    1: North, early, arrived ten minutes late after 90 minutes in the air,
       two of three seats taken.  2: North, half an hour late and not yet
       marked as arrived, so it counts for delay and occupancy only.  3: South,
       in the evening of the next day, five minutes early, one of three seats.
    """
    place = (None, None)
    rows = {
        "aircrafts_data": [("P1", None, None), ("P2", None, None)],
        "airports_data": [
            ("NOR", '{"en": "North Field", "ru": "Север"}', None, place, None),
            ("SOU", '{"en": "South Port Airport"}', None, place, None),
        ],
        "bookings": [("K1", ts("2021-05-01 09:00"), None), ("K2", ts("2021-05-02 10:00"), None)],
        "departures": [
            (1, None, ts("2021-05-01 05:30"), None, "NOR", None, "Arrived", "P1", ts("2021-05-01 05:40"), ts("2021-05-01 07:10")),
            (2, None, ts("2021-05-01 13:00"), None, "NOR", None, "Delayed", "P2", ts("2021-05-01 13:30"), ts("2021-05-01 14:00")),
            (3, None, ts("2021-05-02 18:00"), None, "SOU", None, "Arrived", "P1", ts("2021-05-02 17:55"), ts("2021-05-02 18:55")),
        ],
        "seats": [("P1", "1A", "Economy"), ("P1", "1B", "Economy"), ("P1", "2A", "Business"), ("P2", "1A", "Economy")],
        "segments": [
            ("T1", 1, "Economy", Decimal("100.75")),
            ("T2", 1, "Business", Decimal("250.50")),
            ("T1", 3, "Economy", Decimal("80.10")),
            ("T3", 2, "Economy", Decimal("60.00")),
        ],
        "tickets": [("T1", "K1", None, None, None), ("T2", "K1", None, None, None), ("T3", "K2", None, None, None)],
    }
    return {name: spark.createDataFrame(data, schemas.DOMAIN_SCHEMAS[name]) for name, data in rows.items()}


_PERIODS = dict(zip(schemas.PERIOD_COLUMNS.values(), ([1, 0, 0, 0], [0, 0, 0, 0], [0, 0, 0, 0], [0, 0, 0, 1])))

# By hand: ticket T1 has a segment from each airport, so booking K1 counts two
# North segments (T1, T2) and one South segment on its day.
GOLDEN_EXPECTED = {
    "date": ["2021-05-01", "2021-05-01", "2021-05-02", "2021-05-02"],
    "airport_name": ["North Field", "South Port Airport"] * 2,
    "bookings": [2, 1, 1, 0],
    "revenue": [351, 0, 0, 80],  # 351.25 and 80.10 truncated
    "airtime_minutes": [90.0, 0.0, 0.0, 60.0],
    **_PERIODS,
    "avg_delay_seconds": [1200.0, 0.0, 0.0, -300.0],  # (600 + 1800) / 2
    "avg_occupancy_percent": [75.0, 0.0, 0.0, 33.33],  # 3 of 3 + 1 seats; 1 of 3
    "avg_occupancy_economy": [66.67, 0.0, 0.0, 50.0],
    "avg_occupancy_business": [100.0, 0.0, 0.0, 0.0],
    "avg_occupancy_comfort": [0.0, 0.0, 0.0, 0.0],
}
