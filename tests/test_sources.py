"""Sources and sinks: option building, parquet round trip, the batch job."""

import os
import uuid

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tarmac import run_job
from tarmac.schemas import DOMAIN_SCHEMAS
from tarmac.session import checkpoint_dir
from tarmac.sources import (
    TableSource,
    jdbc_partitions,
    jdbc_source,
    load_domain_tables,
    load_table,
    overwrite_table,
    warehouse_source,
)

from .fixtures import GOLDEN_EXPECTED, golden_tables


def _scratch(spark):
    return os.path.join(checkpoint_dir(spark).replace("file:", ""), "test-tables", uuid.uuid4().hex)


def test_warehouse_source_options():
    src = warehouse_source("proj.airline", staging_bucket="bucket-x")
    assert src.format == "bigquery"
    assert src.reader_options("departures") == {"temporaryGcsBucket": "bucket-x", "table": "proj.airline.departures"}
    assert src.path("departures") is None


def test_jdbc_source_partitions_each_table_by_its_own_column():
    src = jdbc_source(
        "jdbc:postgresql://db/demo",
        {"segments": jdbc_partitions("flight_id", 1, 1000, 16), "bookings": jdbc_partitions("book_date", "2020-01-01", "2021-01-01", 4)},
        names={"departures": "bookings.dep"},
    )
    opts = src.reader_options("segments")
    assert opts["dbtable"] == "segments" and opts["partitionColumn"] == "flight_id" and opts["numPartitions"] == "16"
    assert src.reader_options("bookings")["partitionColumn"] == "book_date"
    assert src.reader_options("departures") == {"url": "jdbc:postgresql://db/demo", "fetchsize": "10000", "dbtable": "bookings.dep"}


def test_run_job_on_tables_as_they_are(spark):
    """DOUBLE amounts, times as text, extra columns and a segments table of another name."""
    base = _scratch(spark)
    t = golden_tables(spark)
    src = TableSource(location=base + "/in/{name}", names={"segments": "segments_v1"})
    for name, df in t.items():
        if name == "segments":
            df = df.withColumn("amount", F.col("amount").cast("double")).withColumn("extra", F.lit(1))
        if name == "departures":
            df = df.withColumns({c: F.col(c).cast("string") for c, kind in df.dtypes if kind == "timestamp_ntz"})
        overwrite_table(df, name, src)
    assert os.path.isdir(base + "/in/segments_v1")
    out = run_job(spark, src, TableSource(location=base + "/out/{name}"))
    got = out.orderBy("date", "airport_name").toPandas()
    pd.testing.assert_frame_equal(pd.DataFrame(GOLDEN_EXPECTED), got, check_dtype=True)
    back = load_domain_tables(spark, src)
    assert all(back[name].schema == DOMAIN_SCHEMAS[name] for name in ("segments", "departures"))


def test_parquet_round_trip_with_declared_schema(spark):
    base = _scratch(spark)
    src = TableSource(location=base + "/{name}")
    t = golden_tables(spark)
    for name, df in t.items():
        overwrite_table(df, name, src)
    back = load_domain_tables(spark, src)
    for name in DOMAIN_SCHEMAS:
        assert sorted(map(tuple, back[name].collect()), key=str) == sorted(map(tuple, t[name].collect()), key=str)
    # overwrite replaces, not appends
    overwrite_table(t["seats"], "seats", src)
    assert load_table(spark, "seats", src).count() == t["seats"].count()


def test_run_job_writes_the_mart(spark):
    base = _scratch(spark)
    src = TableSource(location=base + "/in/{name}")
    for name, df in golden_tables(spark).items():
        overwrite_table(df, name, src)
    out = run_job(spark, src, TableSource(location=base + "/out/{name}"))
    got = out.orderBy("date", "airport_name").toPandas()
    pd.testing.assert_frame_equal(pd.DataFrame(GOLDEN_EXPECTED), got, check_dtype=True)


def test_command_line_job_partitioned_by_date(spark):
    from tarmac.__main__ import main

    base = _scratch(spark)
    src = TableSource(location=base + "/in/{name}")
    for name, df in golden_tables(spark).items():
        overwrite_table(df, name, src)
    main(["--source", base + "/in/{name}", "--sink", base + "/out/{name}", "--partition-by", "date"], spark)
    parts = {d for d in os.listdir(base + "/out/daily_airport_mart") if d.startswith("date=")}
    assert parts == {"date=2021-05-01", "date=2021-05-02"}
    assert spark.read.parquet(base + "/out/daily_airport_mart").count() == 4


def test_command_line_source_building():
    from tarmac.__main__ import _source

    wh = _source("bigquery", None, "proj.airline", "stage-bucket")
    assert wh.format == "bigquery" and wh.reader_options("aggregates") == {
        "temporaryGcsBucket": "stage-bucket",
        "table": "proj.airline.aggregates",
    }
    files = _source("orc", "/data/{name}", None, None)
    assert files.format == "orc" and files.path("tickets") == "/data/tickets"
    db = _source("jdbc", None, None, None, ["url=jdbc:x"], ["segments=segments_v1"], ["segments.numPartitions=8"])
    assert db.reader_options("segments") == {"url": "jdbc:x", "dbtable": "segments_v1", "numPartitions": "8"}
    assert db.reader_options("seats") == {"url": "jdbc:x", "dbtable": "seats"}
    for bad in ((None, None, None), ("/x", None, None, ["url"]), ("/x", None, None, None, None, ["numPartitions=8"])):
        with pytest.raises(SystemExit):
            _source("parquet", *bad)
