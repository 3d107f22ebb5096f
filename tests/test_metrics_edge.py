"""Every metric and the mart on the edge-case fixture, against brute force."""

import pytest

from tarmac import (
    assemble_mart_from_metrics,
    clean_airports,
    daily_airport_mart,
    daily_airtime,
    daily_bookings,
    daily_departure_delay,
    daily_departures_by_day_period,
    daily_occupancy,
    daily_occupancy_by_fare_class,
    daily_revenue,
    date_airport_spine,
)

from tarmac.plans.metrics import delay_by_name
from tarmac.schemas import PERIOD_COLUMNS

from .brute import Data
from .edge_fixture import ROWS, edge_tables


@pytest.fixture(scope="module")
def t(spark):
    return edge_tables(spark)


@pytest.fixture(scope="module")
def brute():
    return Data(ROWS)


def _mart_args(t):
    return (t["aircrafts_data"], t["airports_data"], t["bookings"], t["departures"], t["seats"],
            t["segments"], t["tickets"])


def _as_dict(df, value_cols):
    out = {}
    for r in df.collect():
        key = (r[0], r[1])
        assert key not in out, f"duplicate key {key}"
        out[key] = r[value_cols[0]] if len(value_cols) == 1 else {c: r[c] for c in value_cols}
    return out


def test_airport_names(t):
    got = {r["airport_code"]: (r["airport_name"], r["city_name"]) for r in clean_airports(t["airports_data"]).collect()}
    assert got == {
        "AAA": ("Alpha Airport", "Alpha City"),
        "BBB": ("Бета Аэропорт", ""),  # first entry is Russian: airport keeps Cyrillic, city pattern is ASCII
        "CCC": ("", ""),  # malformed JSON, NULL city
        "DDD": ("", "St. Louis"),  # NULL name; city keeps at most two words
        "EEE": ("Alpha Airport", "Alpha"),  # same cleaned name as AAA
        "FFF": ("Ulan-Ude Airport", "Ulan-Ude"),  # parenthesis stops the match
    }


def test_airport_names_by_language(t):
    got = {r["airport_code"]: r["airport_name"] for r in clean_airports(t["airports_data"], lang="en").collect()}
    assert got["BBB"] == "Beta" and got["AAA"] == "Alpha Airport" and got["CCC"] == ""


def test_bookings(t, brute):
    got = _as_dict(daily_bookings(t["bookings"], t["tickets"], t["segments"], t["departures"],
                                  t["airports_data"]), ["bookings"])
    assert got == brute.bookings_metric()


def test_revenue(t, brute):
    got = _as_dict(daily_revenue(t["departures"], t["airports_data"], t["segments"]), ["revenue"])
    assert got == brute.revenue()
    # AAA and EEE share the name; Arrived only: flight 1 (100.50 + 300.99),
    # flight 2 (200.25 - 10.99), flight 7 (0.01 + 99.99) = 690.75, truncated
    assert got[("2024-03-01", "Alpha Airport")] == 690


def test_airtime(t, brute):
    got = _as_dict(daily_airtime(t["departures"], t["airports_data"]), ["airtime_minutes"])
    assert got == brute.airtime()


def test_day_periods(t, brute):
    cols = list(PERIOD_COLUMNS.values())
    got = _as_dict(daily_departures_by_day_period(t["departures"], t["airports_data"]), cols)
    assert got == brute.periods()
    assert (None, "Alpha Airport") in got  # NULL scheduled time: group kept, all zero


def test_delay(t, brute):
    got = [tuple(r) for r in daily_departure_delay(t["departures"], t["airports_data"]).collect()]
    assert sorted(got, key=str) == sorted(brute.delay_rows(), key=str)
    assert len({r[:2] for r in got}) < len(got)  # two codes share a name
    assert _as_dict(delay_by_name(t["departures"], t["airports_data"]), ["avg_delay_seconds"]) == brute.delay()


def test_occupancy(t, brute):
    got = _as_dict(daily_occupancy(t["departures"], t["seats"], t["segments"], t["airports_data"]),
                   ["avg_occupancy_percent"])
    assert got == brute.occupancy()


def test_occupancy_by_fare_class(t, brute):
    cols = ["avg_occupancy_economy", "avg_occupancy_business", "avg_occupancy_comfort"]
    got = _as_dict(daily_occupancy_by_fare_class(t["seats"], t["aircrafts_data"], t["segments"],
                                                 t["departures"], t["airports_data"]), cols)
    assert got == brute.fare_class()


def test_spine(t, brute):
    got = [tuple(r) for r in date_airport_spine(t["airports_data"], t["departures"], t["bookings"]).collect()]
    assert sorted(got, key=str) == sorted(brute.spine(), key=str)
    assert len(got) == len(set(got))


def test_fused_mart(t, brute):
    got = [tuple(r) for r in daily_airport_mart(*_mart_args(t)).collect()]
    assert got == brute.mart()


def test_assembled_mart_equals_fused(t):
    fused = daily_airport_mart(*_mart_args(t)).collect()
    assembled = assemble_mart_from_metrics(*_mart_args(t)).collect()
    assert [tuple(r) for r in fused] == [tuple(r) for r in assembled]


def test_mart_by_language_uses_one_name_everywhere(t):
    rows = daily_airport_mart(*_mart_args(t), lang="en").collect()
    names = {r["airport_name"] for r in rows}
    assert "Beta" in names and "Бета Аэропорт" not in names
    # bookings of BBB departures are reported under the English name too
    assert sum(r["bookings"] for r in rows if r["airport_name"] == "Beta") == sum(
        r["bookings"] for r in daily_airport_mart(*_mart_args(t)).collect() if r["airport_name"] == "Бета Аэропорт"
    )


def test_assembled_mart_by_language_equals_fused(t):
    fused = daily_airport_mart(*_mart_args(t), lang="en").collect()
    assembled = assemble_mart_from_metrics(*_mart_args(t), lang="en").collect()
    assert [tuple(r) for r in fused] == [tuple(r) for r in assembled]
