"""The fused mart on randomly generated, deliberately skewed data vs brute force.

One departure carries a third of all segments, one booking a third of all
tickets, one airport most departures; ids and times are sometimes NULL and
some keys match nothing.
"""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from tarmac import daily_airport_mart
from tarmac.schemas import DOMAIN_SCHEMAS

from .brute import Data

STATUSES = ["Arrived", "Arrived", "Arrived", "Delayed", "Departed", "Cancelled", None]
CLASSES = ["Economy", "Economy", "Business", "Comfort", "First"]


def skewed_rows(seed):
    rng = random.Random(seed)
    t0 = datetime(2023, 6, 1)
    airports = [
        ("HUB", '{"en": "Hub Airport"}', '{"en": "Hub"}', (0.0, 0.0), "UTC"),
        ("SML", '{"en": "Small Field", "ru": "Поле"}', '{"en": "Small"}', (1.0, 1.0), "UTC"),
        ("DUP", '{"en": "Hub Airport"}', '{"en": "Hub"}', (2.0, 2.0), "UTC"),
        ("BAD", "{oops", None, (3.0, 3.0), "UTC"),
    ]
    aircrafts = [("J1", "{}", 1), ("J2", "{}", 2)]
    seats = [("J1", f"{i}", rng.choice(CLASSES[:4])) for i in range(6)] + [("J2", "1", "Economy"), ("J3", "1", "Business")]
    departures = []
    for fid in range(1, 21):
        sched = t0 + timedelta(days=rng.randrange(3), minutes=rng.randrange(1440)) if rng.random() > 0.05 else None
        dep = None if rng.random() < 0.15 else (sched or t0) + timedelta(minutes=rng.randrange(-20, 90))
        arr = None if dep is None or rng.random() < 0.1 else dep + timedelta(minutes=rng.randrange(30, 400))
        code = "HUB" if rng.random() < 0.6 else rng.choice(["SML", "DUP", "BAD", "NOPE"])
        departures.append((fid if rng.random() > 0.1 else None, f"F{fid}", sched, None, code, "SML",
                        rng.choice(STATUSES), rng.choice(["J1", "J2", "J3", "J9"]), dep, arr))
    bookings = [(f"B{i}", t0 + timedelta(days=rng.randrange(-1, 4), hours=rng.randrange(24)) if rng.random() > 0.05 else None,
                 Decimal("1.00")) for i in range(30)]
    tickets = []
    for i in range(60):
        owner = "B0" if i < 20 else f"B{rng.randrange(40)}"  # B0 holds a third; B30.. do not exist
        tickets.append((f"T{i}", owner, "p", "n", "{}"))
    segments = []
    for i in range(240):
        fid = 1 if i < 80 else (None if rng.random() < 0.05 else rng.randrange(1, 25))  # flight 1 holds a third
        amount = None if rng.random() < 0.03 else Decimal(rng.randrange(-500, 50000)) / 100
        segments.append((f"T{rng.randrange(70)}", fid, rng.choice(CLASSES), amount))
    return {
        "aircrafts_data": aircrafts, "airports_data": airports, "bookings": bookings, "departures": departures,
        "seats": seats, "segments": segments, "tickets": tickets,
    }


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_fused_mart_on_skewed_data(spark, seed):
    rows = skewed_rows(seed)
    t = {name: spark.createDataFrame(r, DOMAIN_SCHEMAS[name]) for name, r in rows.items()}
    got = [tuple(r) for r in daily_airport_mart(t["aircrafts_data"], t["airports_data"], t["bookings"], t["departures"],
                                                t["seats"], t["segments"], t["tickets"]).collect()]
    assert got == Data(rows).mart()
