"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is planned from the driver tables and fully executed into Spark's
``noop`` sink (nothing collected); a timing includes planning, the size-check
job and execution.  After ``BENCH_WARMUP`` (default 4) warm-up runs of the
flagship, every query runs ``BENCH_REPEAT`` times (default 3); the median is
reported.
Prints ONE JSON line; ``value`` is the median wall time of the fused mart.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import uuid  # noqa: E402

from tarmac.catalog import all_queries  # noqa: E402
from tarmac.plans.mart import assemble_mart_from_metrics, daily_airport_mart  # noqa: E402
from tarmac.session import build_session, checkpoint_dir  # noqa: E402
from tarmac.sources import TableSource, bind_domain_tables, load_domain_tables, overwrite_table  # noqa: E402

MART_ARGS = ("aircrafts_data", "airports_data", "bookings", "departures", "seats", "segments", "tickets")

HEADLINE = [
    "daily_airport_mart",
    "daily_airport_mart_assembled",
    "daily_bookings",
    "daily_revenue",
    "daily_airtime",
    "daily_departures_by_day_period",
    "daily_departure_delay",
    "daily_occupancy",
    "daily_occupancy_by_fare_class",
    "date_airport_spine",
    "airports_clean",
]


def default_driver_memory() -> str:
    """60% of this machine's RAM, at most 16 GB (local mode: the driver is the executor)."""
    try:
        with open("/proc/meminfo") as fh:
            kb = next(int(line.split()[1]) for line in fh if line.startswith("MemTotal:"))
        return f"{max(1, min(16, int(kb * 0.6 / 1024**2)))}g"
    except (OSError, StopIteration, ValueError):
        return "4g"


def run_once(spark, fn, sf_dir) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def stored_table_timings(spark, sf_dir, repeat) -> dict[str, float]:
    """The mart over the seven airline tables stored as parquet -- the shape of
    the production job, where departures and segments are tables rather than
    derived from lineitem.  The tables are written once by Spark (derived from
    the driver tables) into the session's checkpoint folder; not timed."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/bench-domain-{uuid.uuid4().hex}"
    source = TableSource(location=base + "/{name}")
    for name, df in bind_domain_tables(spark, sf_dir).items():
        overwrite_table(df, name, source)

    def fused(spark_, _):
        t = load_domain_tables(spark_, source)
        return daily_airport_mart(*(t[n] for n in MART_ARGS))

    def assembled(spark_, _):
        t = load_domain_tables(spark_, source)
        return assemble_mart_from_metrics(*(t[n] for n in MART_ARGS))

    run_once(spark, fused, sf_dir)
    out = {}
    for label, fn in (("daily_airport_mart_stored_tables", fused), ("daily_airport_mart_assembled_stored_tables", assembled)):
        out[label] = round(statistics.median(run_once(spark, fn, sf_dir) for _ in range(repeat)), 3)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE
    spark = build_session(
        master=f"local[{cpus}]",
        app_name="tarmac-bench",
        shuffle_partitions=max(8, 2 * cpus),
        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", default_driver_memory())},
    )
    queries = all_queries()
    warmup = int(os.environ.get("BENCH_WARMUP", "4"))
    # warm-up: JIT compilation of Spark's code paths and of the generated code;
    # the flagship's large plan needs about four runs to reach steady state.
    cold = None
    for i in range(warmup):
        took = run_once(spark, queries[names[0]], sf_dir)
        cold = round(took, 3) if i == 0 else cold
    timings = {}
    for name in names[1:]:  # the others likewise, fewer times: their plans are smaller
        for _ in range(max(1, warmup // 2)):
            run_once(spark, queries[name], sf_dir)
    for name in names:
        runs = [run_once(spark, queries[name], sf_dir) for _ in range(repeat)]
        timings[name] = round(statistics.median(runs), 3)
    if os.environ.get("BENCH_STORED", "1") == "1":
        timings.update(stored_table_timings(spark, sf_dir, repeat))
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(
        json.dumps(
            {
                "metric": "daily_airport_mart_wall_seconds",
                "value": timings[names[0]],
                "unit": "sec",
                "queries": timings,
                "fused_over_assembled": {
                    label: round(timings[f"daily_airport_mart{end}"] / timings[f"daily_airport_mart_assembled{end}"], 3)
                    for label, end in (("driver_tables", ""), ("stored_tables", "_stored_tables"))
                    if f"daily_airport_mart{end}" in timings and f"daily_airport_mart_assembled{end}" in timings
                },
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                "repeat": repeat,
                "warmup": warmup,
                "cold_first_run_sec": cold,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
