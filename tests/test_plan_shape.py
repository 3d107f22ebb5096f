"""Physical-plan properties of the fused mart over stored parquet tables."""

import io
import os
import uuid
from contextlib import redirect_stdout

import pytest

from tarmac import assemble_mart_from_metrics, daily_airport_mart
from tarmac.session import checkpoint_dir
from tarmac.sources import TableSource, load_domain_tables, overwrite_table

from .edge_fixture import edge_tables

ORDER = ("aircrafts_data", "airports_data", "bookings", "departures", "seats", "segments", "tickets")


@pytest.fixture(scope="module")
def stored(spark):
    base = os.path.join(checkpoint_dir(spark).replace("file:", ""), "plan-shape", uuid.uuid4().hex)
    src = TableSource(location=base + "/{name}")
    for name, df in edge_tables(spark).items():
        overwrite_table(df, name, src)
    return load_domain_tables(spark, src)


def _plan(df):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _scans(plan, table):
    """The formatted-plan blocks of every scan of ``table``."""
    blocks = plan.split("\n\n")
    return [b for b in blocks if "Scan parquet" in b.strip().split("\n")[0] and f"/{table}]" in b]


def test_completed_filter_reaches_the_departures_scan(stored):
    plan = _plan(daily_airport_mart(*(stored[n] for n in ORDER)))
    scans = _scans(plan, "departures")
    assert any(
        "IsNotNull(actual_departure)" in s and "IsNotNull(actual_arrival)" in s for s in scans
    ), scans


def test_scans_read_only_needed_columns(stored):
    plan = _plan(daily_airport_mart(*(stored[n] for n in ORDER)))
    for s in _scans(plan, "segments"):
        assert "amount" in s or "ticket_no" in s
    for s in _scans(plan, "tickets"):
        assert "passenger_name" not in s and "contact_data" not in s
    for s in _scans(plan, "airports_data"):
        assert "coordinates" not in s and "timezone" not in s


def test_grid_is_the_only_product_and_it_is_broadcast(stored):
    plan = _plan(daily_airport_mart(*(stored[n] for n in ORDER)))
    assert "CartesianProduct" not in plan
    tree = [line for line in plan.split("\n\n")[0].splitlines() if "NestedLoopJoin" in line]
    assert len(tree) == 1 and "BroadcastNestedLoopJoin Cross BuildRight" in tree[0], tree


def test_fused_plan_reads_departures_fewer_times(stored):
    fused = len(_scans(_plan(daily_airport_mart(*(stored[n] for n in ORDER))), "departures"))
    assembled = len(_scans(_plan(assemble_mart_from_metrics(*(stored[n] for n in ORDER))), "departures"))
    assert fused <= 3 < assembled


def test_planning_runs_no_job(spark, stored):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "no job may start while a plan is built")
    try:
        _plan(daily_airport_mart(*(stored[n] for n in ORDER)))
        assert list(tracker.getJobIdsForGroup("planning")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_seats_and_names_meet_grouped_rows_only(stored):
    """No join on aircraft or airport code at the grain of departures: each has an aggregate below it."""
    tree = _plan(daily_airport_mart(*(stored[n] for n in ORDER))).split("\n\n")[0].splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    joins = [i for i, line in enumerate(tree) if "HashJoin LeftOuter" in line or "SortMergeJoin LeftOuter" in line]
    assert joins
    for i in joins:
        below = [line for line in tree[i + 1 :]][: next((j for j, line in enumerate(tree[i + 1 :]) if depth(line) <= depth(tree[i])), None)]
        assert any("HashAggregate" in line for line in below), tree[i]


def test_bookings_read_each_table_once(stored):
    """Counts are pushed below the joins: no anti join, and no table is scanned twice."""
    from tarmac import daily_bookings

    names = ("bookings", "tickets", "segments", "departures", "airports_data")
    alone = _plan(daily_bookings(*(stored[n] for n in names)))
    assert "LeftAnti" not in alone
    assert {n: len(_scans(alone, n)) for n in names} == dict.fromkeys(names, 1)


def test_bookings_of_the_mart_are_inner_joins(stored):
    """Rows without a name can never match the grid."""
    plan = _plan(daily_airport_mart(*(stored[n] for n in ORDER)))
    assert "LeftAnti" not in plan and len(_scans(plan, "tickets")) == 1


def test_order_needs_no_sampling_pass(stored):
    """The days' ranks are the bounds of the ranges: no range partitioning, the same order."""
    mart = daily_airport_mart(*(stored[n] for n in ORDER))
    assert "rangepartitioning" not in _plan(mart)
    got = [(r.date, r.airport_name) for r in mart.collect()]
    assert got == sorted(got, key=lambda x: (x[0] is not None, x[0] or "", x[1])) and len(set(got)) == len(got)
