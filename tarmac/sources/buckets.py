"""The domain tables stored by the keys they are joined on, so that joins need no shuffle.

``save_bucketed`` writes external Parquet tables into the session's catalog:
departures and segments in buckets of flight_id, bookings and tickets in those
of book_ref, and the segments' keys once more in those of ticket_no.  With
``BUCKETED_SETTINGS`` the mart's joins on these keys read the buckets as they lie;
what is still shuffled are grouped rows, and bookings on their way from
book_ref to ticket_no.

A bucket holds all rows of a key, rows without one included, so a hot key is
a large file; Spark still reads it by several tasks where no join needs the
buckets, but a join on the key does not split it.  Tables with such keys are
better left unbucketed (AQE splits their joins).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

#: Joins on a bucket's key and more (``left_join_unique`` adds a column) accept the buckets.
BUCKETED_SETTINGS = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}
BUCKET_KEYS = {
    "departures": "flight_id",
    "segments": "flight_id",
    "bookings": "book_ref",
    "tickets": "book_ref",
    "segments_by_ticket": "ticket_no",
}


def save_bucketed(tables: Mapping[str, DataFrame], location: str, prefix: str, buckets: int) -> None:
    """Store the seven tables as ``<prefix>_<table>`` under ``location``, replacing them.

    ``buckets`` should let the largest table's bucket be some 256 MB.
    """
    every = {**tables, "segments_by_ticket": tables["segments"].select("ticket_no", "flight_id")}
    for name, df in every.items():
        writer = df.write.format("parquet").mode("overwrite").option("path", f"{location.rstrip('/')}/{name}")
        if name in BUCKET_KEYS:
            # one file a bucket: rows are dealt as the buckets are
            key = BUCKET_KEYS[name]
            writer = df.repartition(buckets, key).write.format("parquet").mode("overwrite")
            writer = writer.option("path", f"{location.rstrip('/')}/{name}").bucketBy(buckets, key).sortBy(key)
        writer.saveAsTable(f"{prefix}_{name}")


def load_bucketed(spark: SparkSession, prefix: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: spark.table(f"{prefix}_{name}") for name in names}
