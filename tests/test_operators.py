"""Joins that spread hot and missing keys: results, and how rows are dealt."""

import pytest
from pyspark.sql import functions as F

from tarmac.operators.joins import left_join_few_codes, left_join_unique, split_left_join


@pytest.fixture
def shuffled(spark):
    """Sort-merge joins over 16 partitions, as dealt (no adaptive change)."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def _largest_share(df):
    counts = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(counts) / sum(counts)


def _hot(spark, hot):
    """20,000 rows, 60% of them with the key ``hot``."""
    return spark.range(20_000).select(F.when(F.col("id") % 10 < 6, F.lit(hot)).otherwise(F.col("id")).cast("long").alias("k"), F.col("id").alias("v"))


def test_rows_without_a_key_are_spread(shuffled):
    left, right = _hot(shuffled, None), shuffled.range(0, 20_000, 3).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    plain = left.join(right, "k", "left")
    spread = left_join_unique(left, right, "k", ["v"])
    assert _largest_share(plain) > 0.6 > 0.2 > _largest_share(spread)
    assert sorted(map(tuple, spread.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_a_hot_code_is_spread(shuffled):
    left, right = _hot(shuffled, 7), shuffled.range(0, 20_000, 3).select((F.col("id") + 1).alias("k"), F.col("id").alias("w"))
    plain = left.join(right, "k", "left")
    spread = left_join_few_codes(left, right, "k", ["v"])
    assert _largest_share(plain) > 0.6 > 0.3 > _largest_share(spread)
    assert sorted(map(tuple, spread.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_rows_without_a_key_pass_by_the_join(shuffled):
    matched, unmatched = split_left_join(_hot(shuffled, None), shuffled.range(100).withColumnRenamed("id", "k"), "k")
    assert unmatched.filter("k IS NULL").count() == 12_000
    assert _largest_share(unmatched) < 0.3


@pytest.mark.parametrize("side", ["left", "right"])
def test_aqe_splits_a_hot_key_of_the_inner_join(spark, side, tmp_path):
    """Over stored tables, broadcast off and thresholds lowered, the inner part of split_left_join is split."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    hot = _hot(spark, 7)
    few = spark.range(0, 20_000, 3).select((F.col("id") + 1).alias("k"), F.col("id").alias("w"))
    hot.repartition(8).write.parquet(str(tmp_path / "hot"))
    few.write.parquet(str(tmp_path / "few"))
    hot, few = spark.read.parquet(str(tmp_path / "hot")), spark.read.parquet(str(tmp_path / "few"))
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        matched, _ = split_left_join(*((hot, few) if side == "left" else (few, hot)), "k")
        matched.collect()
        assert "skew=true" in matched._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_aqe_splits_a_hot_departure_of_the_bookings_chain(spark, tmp_path):
    """Half of all segments are of one departure, and a third of them of none."""
    from tarmac import daily_bookings

    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    n = F.col("id")
    flight = F.when(n % 6 < 3, F.lit(7)).when(n % 6 == 3, n % 1000).cast("long")
    tables = {
        "segments": spark.range(30_000).select((n % 9000).cast("string").alias("ticket_no"), flight.alias("flight_id")).repartition(8),
        "tickets": spark.range(10_000).select(n.cast("string").alias("ticket_no"), F.when(n % 3 > 0, n % 4000).cast("string").alias("book_ref")),
        "bookings": spark.range(5_000).select(n.cast("string").alias("book_ref"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("book_date")),
        "departures": spark.range(1_000).select(n.alias("flight_id"), F.concat(F.lit("C"), n % 5).alias("departure_airport")),
        "airports": spark.range(4).select(F.concat(F.lit("C"), n).alias("airport_code"), F.concat(F.lit('{"en": "N'), F.lit('"}')).alias("airport_name"), F.lit(None).cast("string").alias("city")),
    }
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
    t = {name: spark.read.parquet(str(tmp_path / name)) for name in tables}
    chain = t["bookings"].join(t["tickets"], "book_ref", "left").join(t["segments"], "ticket_no", "left").join(t["departures"], "flight_id", "left")
    want = {r.known: r["count"] for r in chain.groupBy(F.col("departure_airport").isin("C0", "C1", "C2", "C3").alias("known")).count().collect()}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        found = daily_bookings(t["bookings"], t["tickets"], t["segments"], t["departures"], t["airports"])
        got = {r.airport_name: r.bookings for r in found.collect()}
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == {"N": want[True], None: want.get(False, 0) + want.get(None, 0)}


def test_left_join_fanout_equals_left_join(spark):
    import random

    from tarmac.operators.joins import left_join_fanout

    rng = random.Random(7)
    for _ in range(4):
        keys = [None, "hot"] + [f"k{i}" for i in range(6)]
        left = [(rng.choice(keys), i) for i in range(40)]
        # a hot key holding a third of the right side, plus NULL keys and misses
        right = [("hot", -i) for i in range(20)] + [(rng.choice(keys + ["zz"]), 100 + i) for i in range(40)]
        ldf = spark.createDataFrame(left, "k string, a int")
        rdf = spark.createDataFrame(right, "k string, b int")
        expected = sorted(map(tuple, ldf.join(rdf, "k", "left").collect()), key=str)
        got = sorted(map(tuple, left_join_fanout(ldf, rdf, "k").collect()), key=str)
        assert got == expected


def test_left_join_fanout_rejects_ambiguous_columns(spark):
    import pytest

    from tarmac.operators.joins import left_join_fanout

    with pytest.raises(ValueError):
        left_join_fanout(spark.range(3).selectExpr("id AS k", "id AS v"),
                         spark.range(3).selectExpr("id AS k", "id AS v"), "k")


def test_slots_are_even_runs_of_days(spark):
    from tarmac.operators.ordering import SLOT, in_day_order, with_slots

    days = spark.createDataFrame([(f"2024-01-{d:02d}",) for d in range(1, 30)] + [(None,)], "day string")
    found = {r.day: r[SLOT] for r in with_slots(days, 4).collect()}
    order = [found[d] for d in sorted(found, key=lambda d: d or "")]
    assert order == sorted(order) and set(order) == {0, 1, 2, 3} and found[None] == 0
    rows = with_slots(days, 4).crossJoin(spark.createDataFrame([("b",), ("a",), (None,)], "name string"))
    got = [tuple(r) for r in in_day_order(rows, 4, "day", "name").collect()]
    assert got == sorted(got, key=lambda x: (x[0] or "", x[1] or ""))
    one = with_slots(days.limit(1), 4).collect()
    assert [r[SLOT] for r in one] == [0]
