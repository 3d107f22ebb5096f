"""Stored sums: a refresh of changed days equals the full run, and reads only those days."""

import os
import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from tarmac import daily_airport_mart
from tarmac.plans.incremental import EVERY_DAY, day_sums, refresh, stored_mart
from tarmac.session import checkpoint_dir
from tarmac.sources import versions

from .edge_fixture import edge_tables
from .test_plan_shape import ORDER, _plan

FLEET = ("aircrafts_data", "airports_data", "seats")


@pytest.fixture
def root(spark):
    return os.path.join(checkpoint_dir(spark).replace("file:", ""), "sums", uuid.uuid4().hex)


def _mart(spark, root, t):
    return [tuple(r) for r in stored_mart(spark, root, *(t[n] for n in FLEET)).collect()]


def _full(t):
    return [tuple(r) for r in daily_airport_mart(*(t[n] for n in ORDER)).collect()]


def test_all_days_equal_the_full_run(spark, root):
    t = edge_tables(spark)
    refresh(spark, t, root)
    assert _mart(spark, root, t) == _full(t)


def test_new_days_are_added(spark, root):
    t = edge_tables(spark)
    cut = date(2024, 3, 2)
    refresh(spark, t, root, [(None, date(2024, 3, 1)), None])
    before = {r.day for r in versions.read_table(spark, root).select("day").distinct().collect()}
    assert before == {None, date(2024, 2, 28), date(2024, 3, 1)}
    manifest = refresh(spark, t, root, [(cut, None)])
    assert _mart(spark, root, t) == _full(t)
    old = [p for p, v in manifest.parts.items() if "=000000000001-" in v[0]]
    assert "month=2024-02" in old and "month=2024-03" not in old


def test_changed_and_removed_days(spark, root):
    t = edge_tables(spark)
    refresh(spark, t, root)
    changed = dict(t)
    changed["departures"] = t["departures"].filter("scheduled_departure IS NULL OR to_date(scheduled_departure) <> '2024-03-03'").withColumn(
        "status", F.when(F.to_date("scheduled_departure") == "2024-03-02", F.lit("Arrived")).otherwise(F.col("status"))
    )
    changed["bookings"] = t["bookings"].filter("book_date IS NULL OR to_date(book_date) NOT IN ('2024-03-03', '2024-02-28')")
    refresh(spark, changed, root, [(date(2024, 3, 2), date(2024, 3, 3)), (date(2024, 2, 28), date(2024, 2, 28))])
    assert _mart(spark, root, changed) == _full(changed)
    assert not any("2024-02" in p for p in versions.newest_manifest(spark, root).parts)


def test_the_condition_reaches_the_scans(spark, tmp_path):
    t = {}
    for name, df in edge_tables(spark).items():
        df.write.parquet(str(tmp_path / name))
        t[name] = spark.read.parquet(str(tmp_path / name))
    plan = _plan(day_sums(t, [(date(2024, 3, 2), None)]))
    scans = [b for b in plan.split("\n\n") if "Scan parquet" in b and "/bookings]" in b]
    assert scans and all("GreaterThanOrEqual(book_date,2024-03-02" in s for s in scans)
    assert any("GreaterThanOrEqual(scheduled_departure,2024-03-02" in b for b in plan.split("\n\n"))


def test_empty_tables(spark, root):
    t = {name: df.limit(0) for name, df in edge_tables(spark).items()}
    refresh(spark, t, root, EVERY_DAY)
    assert _mart(spark, root, t) == []
