"""A small airline data set that hits every edge case listed in FIXTURES.md:
non-Arrived statuses, NULL actual times, NULL flight_id, a booking without
ticket, a ticket without segment, tickets with several segments, an unmatched
airport code, malformed / NULL / ru-first name JSON, two codes with the same
cleaned name, fractional and negative amounts, an early departure, hours at
every period boundary, a class with zero seats but passengers, NULL
book_date, NULL scheduled_departure, an aircraft missing from aircrafts_data
but present in seats, a fare class outside the three, fractional seconds."""

from datetime import datetime
from decimal import Decimal

from tarmac import schemas


def dt(text):
    if text is None:
        return None
    fmt = "%Y-%m-%d %H:%M:%S.%f" if "." in text else "%Y-%m-%d %H:%M:%S" if ":" in text else "%Y-%m-%d"
    return datetime.strptime(text, fmt)


AIRCRAFTS = [
    ("A1", '{"en": "Jet One"}', 1000),
    ("A2", '{"en": "Jet Two"}', 2000),
    ("A2", '{"en": "Jet Two again"}', 2000),
    ("A9", '{"en": "Jet Nine"}', 9000),
]

AIRPORTS = [
    ("AAA", '{"en": "Alpha Airport", "ru": "Альфа"}', '{"en": "Alpha City", "ru": "Альфа"}', (1.0, 2.0), "UTC"),
    ("BBB", '{"ru": "Бета Аэропорт", "en": "Beta"}', '{"ru": "Бета", "en": "Beta"}', (3.0, 4.0), "UTC"),
    ("CCC", "not json at all", None, (5.0, 6.0), "UTC"),
    ("DDD", None, '{"en": "St. Louis Park East"}', (7.0, 8.0), "UTC"),
    ("EEE", '{"en": "Alpha Airport"}', '{"en": "Alpha"}', (9.0, 10.0), "UTC"),
    ("FFF", '{"en": "Ulan-Ude Airport (Mukhino)", "ru": "Улан-Удэ"}', '{"en": "Ulan-Ude"}', (11.0, 12.0), "UTC"),
]

BOOKINGS = [
    ("B1", dt("2024-02-28 10:00:00"), Decimal("1.00")),
    ("B2", dt("2024-03-01 23:59:59"), Decimal("1.00")),
    ("B3", dt("2024-03-01 00:00:00"), Decimal("1.00")),
    ("B4", None, Decimal("1.00")),
    ("B5", dt("2024-03-02 12:00:00"), Decimal("1.00")),
    ("B6", dt("2024-03-02 00:00:01"), Decimal("1.00")),
    ("B7", dt("2024-03-03 08:00:00"), Decimal("1.00")),
    ("B8", dt("2024-03-04 09:00:00"), Decimal("1.00")),
]

# flight_id, no, sched_dep, sched_arr, dep_airport, arr_airport, status, aircraft, act_dep, act_arr
DEPARTURES = [
    (1, "F1", dt("2024-03-01 00:10:00"), None, "AAA", "BBB", "Arrived", "A1",
     dt("2024-03-01 00:05:00"), dt("2024-03-01 01:05:00")),
    (2, "F2", dt("2024-03-01 05:59:00"), None, "AAA", "BBB", "Arrived", "A2",
     dt("2024-03-01 06:10:00"), dt("2024-03-01 07:40:00")),
    (3, "F3", dt("2024-03-01 06:00:00"), None, "AAA", "BBB", "Delayed", "A1",
     dt("2024-03-01 06:30:00"), dt("2024-03-01 08:00:00")),
    (4, "F4", dt("2024-03-01 11:59:00"), None, "BBB", "AAA", "Cancelled", "A1", None, None),
    (5, "F5", dt("2024-03-01 12:00:00"), None, "BBB", "AAA", "Departed", "A2", dt("2024-03-01 12:10:00"), None),
    (None, "F6", dt("2024-03-01 17:59:00"), None, "BBB", "AAA", "Arrived", "A1",
     dt("2024-03-01 18:01:00"), dt("2024-03-01 19:00:00")),
    (7, "F7", dt("2024-03-01 18:00:00"), None, "EEE", "AAA", "Arrived", "A7",
     dt("2024-03-01 18:00:00"), dt("2024-03-01 20:30:00")),
    (8, "F8", dt("2024-03-02 23:59:00"), None, "ZZZ", "AAA", "Arrived", "A1",
     dt("2024-03-03 00:10:00"), dt("2024-03-03 01:00:00")),
    (9, "F9", dt("2024-03-02 12:30:00"), None, "CCC", "AAA", "Arrived", "A9",
     dt("2024-03-02 12:31:00"), dt("2024-03-02 13:31:00")),
    (10, "F10", dt("2024-03-02 17:00:00"), None, "DDD", "AAA", "Arrived", "A1",
     dt("2024-03-02 16:55:00"), dt("2024-03-02 18:00:00")),
    (11, "F11", dt("2024-03-02 23:00:00"), None, "FFF", "AAA", "Arrived", "A2",
     dt("2024-03-02 23:00:30.900"), dt("2024-03-03 00:00:59.999")),
    (12, "F12", None, None, "AAA", "BBB", "Arrived", "A1", dt("2024-03-02 10:00:00"), dt("2024-03-02 11:00:00")),
    (14, "F14", dt("2024-03-03 08:00:00"), None, "AAA", "BBB", "Arrived", "A1",
     dt("2024-03-03 08:00:00"), dt("2024-03-03 09:00:00")),
    (15, "F15", dt("2024-03-03 11:00:00"), None, "BBB", "AAA", None, "A2",
     dt("2024-03-03 11:00:00"), dt("2024-03-03 12:00:00")),
]

SEATS = [
    ("A1", "1A", "Economy"), ("A1", "1B", "Economy"), ("A1", "1C", "Economy"),
    ("A1", "2A", "Business"), ("A1", "0A", "First"),
    ("A2", "1A", "Economy"), ("A2", "1B", "Economy"), ("A2", "2A", "Comfort"),
    ("A7", "1A", "Economy"), ("A7", "1B", "Economy"), ("A7", "2A", "Business"),
]

SEGMENTS = [
    ("T1", 1, "Economy", Decimal("100.50")),
    ("T1", 2, "Economy", Decimal("200.25")),
    ("T2", 1, "Business", Decimal("300.99")),
    ("T2", 3, "Comfort", Decimal("50.00")),
    ("T3", 2, "Comfort", Decimal("-10.99")),
    ("T4", 7, "Economy", Decimal("0.01")),
    ("T4", 7, "Business", Decimal("99.99")),
    ("T5", 8, "Economy", Decimal("10.00")),
    ("T5", None, "Economy", Decimal("5.00")),
    ("T6", 9, "Economy", Decimal("1.00")),
    ("T6", 10, "First", Decimal("2.00")),
    ("T7", 11, "Economy", Decimal("3.33")),
    ("T8", 99, "Economy", Decimal("4.00")),
    ("T9", 12, "Economy", Decimal("1.50")),
    ("T12", 15, "Economy", None),
]

TICKETS = [
    ("T1", "B1", "p1", "P ONE", "{}"),
    ("T2", "B1", "p2", "P TWO", "{}"),
    ("T3", "B2", "p3", "P THREE", "{}"),
    ("T4", "B3", "p4", "P FOUR", "{}"),
    ("T5", "B3", "p5", "P FIVE", "{}"),
    ("T6", "B4", "p6", "P SIX", "{}"),
    ("T7", "B5", "p7", "P SEVEN", "{}"),
    ("T8", "B5", "p8", "P EIGHT", "{}"),
    ("T9", "B6", "p9", "P NINE", "{}"),
    ("T11", "B7", "p11", "P ELEVEN", "{}"),
    ("T12", "B7", "p12", "P TWELVE", "{}"),
]

ROWS = {
    "aircrafts_data": AIRCRAFTS,
    "airports_data": AIRPORTS,
    "bookings": BOOKINGS,
    "departures": DEPARTURES,
    "seats": SEATS,
    "segments": SEGMENTS,
    "tickets": TICKETS,
}


def edge_tables(spark):
    return {name: spark.createDataFrame(rows, schemas.DOMAIN_SCHEMAS[name]) for name, rows in ROWS.items()}
