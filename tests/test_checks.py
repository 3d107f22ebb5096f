"""Data checks in the mart's own pass, and the tables stored by their join keys."""

import os
import uuid
from collections import Counter

import pytest

from tarmac import daily_airport_mart, run_job
from tarmac.__main__ import main
from tarmac.plans.checks import Checks
from tarmac.session import checkpoint_dir
from tarmac.sources import TableSource, overwrite_table, write_dump
from tarmac.sources.buckets import BUCKETED_SETTINGS, load_bucketed, save_bucketed

from .edge_fixture import ROWS, edge_tables
from .test_plan_shape import ORDER, _plan, _scans


@pytest.fixture
def base(spark):
    return os.path.join(checkpoint_dir(spark).replace("file:", ""), "checks", uuid.uuid4().hex)


def test_job_reports_what_passed_by(spark, base):
    t = edge_tables(spark)
    src = TableSource(location=base + "/in/{name}")
    for name, df in t.items():
        overwrite_table(df, name, src)
    checks = Checks()
    mart = run_job(spark, src, TableSource(location=base + "/out/{name}"), checks=checks)
    done = [d for d in ROWS["departures"] if d[8] is not None and d[9] is not None and d[2] is not None]
    no_day = [d for d in ROWS["departures"] if d[8] is not None and d[9] is not None and d[2] is None]
    codes = Counter(a[0] for a in ROWS["airports_data"])
    report = checks.report()
    assert report["completed"] == len(done)  # a delay needs the scheduled time too
    assert no_day and report["unmatched"] == sum(codes[d[4]] == 0 for d in done)
    assert report["repeated"] == 0
    rows = mart.collect()
    assert report["rows"] == len(rows)
    assert report["without_day"] == sum(r.date is None for r in rows) > 0
    assert report["without_name"] == sum(r.airport_name == "" for r in rows) > 0


def test_a_code_listed_twice_is_reported(spark):
    t = edge_tables(spark)
    t["airports_data"] = t["airports_data"].union(t["airports_data"].filter("airport_code = 'AAA'"))
    checks = Checks()
    daily_airport_mart(*(t[n] for n in ORDER), checks=checks).collect()
    assert checks.report()["repeated"] == sum(d[4] == "AAA" and None not in (d[2], d[8], d[9]) for d in ROWS["departures"])


def test_checks_cost_no_scan(spark, base):
    t = edge_tables(spark)
    src = TableSource(location=base + "/{name}")
    for name, df in t.items():
        overwrite_table(df, name, src)
    stored = {n: spark.read.parquet(f"{base}/{n}") for n in t}
    plain = _plan(daily_airport_mart(*(stored[n] for n in ORDER)))
    checked = _plan(daily_airport_mart(*(stored[n] for n in ORDER), checks=Checks()))
    for n in ORDER:
        assert len(_scans(plain, n)) == len(_scans(checked, n))
    assert any("IsNotNull(actual_departure)" in s for s in _scans(checked, "departures"))


def test_job_from_a_dump_with_published_names(spark, base, capsys):
    for name, df in edge_tables(spark).items():
        write_dump(df, base + "/dump", name)
    main(
        ["--source", base + "/dump", "--source-format", "copy_dump", "--sink", base + "/out/{name}", "--sink-format", "versioned",
         "--column", "departures_morning=flown_before_noon"],
        spark,
    )
    assert "unmatched 1" in capsys.readouterr().out
    from tarmac.sources.versions import read_table

    got = read_table(spark, base + "/out/daily_airport_mart")
    assert "flown_before_noon" in got.columns and got.count() == daily_airport_mart(*(edge_tables(spark)[n] for n in ORDER)).count()


def test_joins_over_bucketed_tables_need_no_shuffle(spark, base):
    prefix = "b" + uuid.uuid4().hex
    save_bucketed(edge_tables(spark), base, prefix, buckets=4)
    t = load_bucketed(spark, prefix, [*ORDER, "segments_by_ticket"])
    conf = {**BUCKETED_SETTINGS, "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "4"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        mart = daily_airport_mart(*(t[n] for n in ORDER), segments_by_ticket=t["segments_by_ticket"])
        plan = _plan(mart)
        dealt = [line.split(", ENSURE")[0] for line in plan.splitlines() if line.startswith("Arguments: hashpartitioning")]
        # by ticket_no: the bookings that come from book_ref; by flight_id: counts by (flight_id, day)
        assert sum("ticket_no" in x for x in dealt) == 1 and not any("book_ref" in x for x in dealt)
        assert sum(x.startswith("Arguments: hashpartitioning(flight_id") for x in dealt) <= 2, dealt
        got = mart.collect()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        for n in [*ORDER, "segments_by_ticket"]:
            spark.sql(f"DROP TABLE {prefix}_{n}")
    assert got == daily_airport_mart(*(edge_tables(spark)[n] for n in ORDER)).collect()
