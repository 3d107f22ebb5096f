"""Versioned tables and the staged sink: old or new, never a part of either."""

import json
import os
import subprocess
import sys
import textwrap
import uuid

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tarmac.session import checkpoint_dir
from tarmac.sources import TableSource, load_table, overwrite_table
from tarmac.sources import staged as S
from tarmac.sources import versions as V


@pytest.fixture
def root(spark):
    return os.path.join(checkpoint_dir(spark).replace("file:", ""), "versions", uuid.uuid4().hex)


def rows(df):
    return sorted(map(tuple, df.collect()))


def days(spark, names, value):
    return spark.createDataFrame([(i, d, value) for d in names for i in range(3)], "id long, day string, value string")


def test_overwrite_from_itself(spark, root):
    V.overwrite(days(spark, ["2024-01-01", "2024-01-02"], "a"), root)
    table = V.read_table(spark, root)
    V.overwrite(table.withColumn("value", F.upper("value")).filter("id > 0"), root)
    assert rows(V.read_table(spark, root)) == [(i, d, "A") for i in (1, 2) for d in ("2024-01-01", "2024-01-02")]
    assert table.count() == 6  # a reader of the old version still has all of it


def test_dynamic_overwrite_changes_only_the_partitions_it_has(spark, root):
    source = TableSource(format="versioned", location=root + "/{name}")
    overwrite_table(days(spark, ["2024-01-01", "2024-01-02", "x y=%"], "a"), "t", source, ["day"])
    changed = load_table(spark, "t", source).filter("day = '2024-01-02'").withColumn("value", F.lit("b"))
    more = changed.select("id", "day", "value").unionByName(days(spark, ["2024-01-03"], "c"))
    overwrite_table(more, "t", source, ["day"], dynamic=True)
    got = load_table(spark, "t", source)
    assert got.columns == ["id", "value", "day"] and dict(got.dtypes)["day"] == "string"
    by_day = {r["day"]: (r["count"], r["v"]) for r in got.groupBy("day").agg(F.count("*").alias("count"), F.max("value").alias("v")).collect()}
    assert by_day == {"2024-01-01": (3, "a"), "2024-01-02": (3, "b"), "2024-01-03": (3, "c"), "x y=%": (3, "a")}
    assert {"/day=" + f.split("/day=")[1].split("/")[0] for f in got.filter("day = '2024-01-03'").inputFiles()} >= {"/day=2024-01-03"}
    with pytest.raises(ValueError):
        V.overwrite(more, root + "/t", ["value"], dynamic=True)


def test_failed_write_changes_nothing(spark, root):
    V.overwrite(days(spark, ["d"], "a"), root)
    with pytest.raises(Exception, match="boom"):
        V.overwrite(days(spark, ["d"], "b").repartition(4).withColumn("value", F.raise_error(F.lit("boom")).cast("string")), root)
    assert {r.value for r in V.read_table(spark, root).collect()} == {"a"}
    before = V.newest_manifest(spark, root).number
    V.overwrite(days(spark, ["e"], "c"), root)
    assert V.newest_manifest(spark, root).number == before + 1
    V.vacuum(spark, root)
    assert len(os.listdir(root + "/data")) == 1 and rows(V.read_table(spark, root)) == [(i, "e", "c") for i in range(3)]


def test_vacuum_keeps_partitions_of_older_writes(spark, root):
    V.overwrite(days(spark, ["a", "b"], "1"), root, ["day"])
    V.overwrite(days(spark, ["b"], "2"), root, ["day"], dynamic=True)
    gone = V.vacuum(spark, root)
    assert any(g.endswith("day=b") for g in gone) and not any(g.endswith("day=a") for g in gone)
    assert sorted(r.value for r in V.read_table(spark, root).collect()) == ["1"] * 3 + ["2"] * 3
    assert V.vacuum(spark, root) == []


def test_empty_tables(spark, root):
    V.overwrite(days(spark, [], "a"), root + "/plain")
    V.overwrite(days(spark, [], "a"), root + "/parts", ["day"])
    assert V.read_table(spark, root + "/plain").collect() == [] == V.read_table(spark, root + "/parts").collect()
    with pytest.raises(FileNotFoundError):
        V.read_table(spark, root + "/none")


def test_an_unfinished_manifest_is_not_read(spark, root):
    V.overwrite(days(spark, ["d"], "a"), root)
    with open(f"{root}/manifests/.{uuid.uuid4().hex}", "w") as f:
        f.write("{")
    assert V.read_table(spark, root).count() == 3


def test_staged_sink_replaces_and_appends(spark, root):
    source = TableSource(format="staged", location=root + "/{name}", options={"staging": root + "/stage"})
    overwrite_table(days(spark, ["a", "b"], "1").repartition(3), "t", source)
    days(spark, ["c"], "2").write.format("staged").mode("append").save(root + "/t")
    assert sorted({(r.day, r.value) for r in load_table(spark, "t", source).collect()}) == [("a", "1"), ("b", "1"), ("c", "2")]
    overwrite_table(load_table(spark, "t", source).filter("day = 'c'"), "t", source)
    assert rows(load_table(spark, "t", source)) == [(i, "c", "2") for i in range(3)]


def test_staged_sink_leaves_the_old_table_when_a_task_fails(spark, root):
    S.register(spark)
    days(spark, ["a"], "1").write.format("staged").mode("overwrite").save(root)
    bad = spark.range(40).repartition(4).select(F.when(F.col("id") == 39, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="boom"):
        bad.write.format("staged").mode("overwrite").save(root)
    assert rows(V.read_table(spark, root)) == [(i, "a", "1") for i in range(3)]


def test_an_attempt_that_is_not_committed_leaves_no_rows(spark, root):
    schema = spark.range(1).schema
    writer = S.StagedWriter(root, None, schema, overwrite=True)
    batch = pa.record_batch({"id": pa.array([1, 2, 3], pa.int64())})
    writer.write(iter([batch]))  # the first attempt, lost before it could report
    writer.commit([writer.write(iter([batch])), None])
    assert rows(V.read_table(spark, root)) == [(1,), (2,), (3,)]
    (folder,) = os.listdir(root + "/data")
    assert len(os.listdir(f"{root}/data/{folder}")) == 1


def test_a_retried_task_leaves_no_duplicate(root):
    """In a session of its own, whose tasks are tried again."""
    script = textwrap.dedent(
        f"""
        import os, sys
        from tarmac.session import build_session
        from tarmac.sources import staged, versions
        spark = build_session(master="local[2,4]", shuffle_partitions=2)
        staged.register(spark)
        mark = {root + "-failed"!r}

        def once(batches):
            for batch in batches:
                yield batch
            if not os.path.exists(mark):
                open(mark, "w").close()
                raise ValueError("first attempt")

        df = spark.range(0, 1000, 1, 4).mapInArrow(once, "id long")
        df.write.format("staged").mode("overwrite").save({root!r})
        got = versions.read_table(spark, {root!r})
        print("ROWS", got.count(), got.distinct().count())
        """
    )
    out = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=240, env={**os.environ, "PYTHONPATH": os.getcwd()})
    assert "ROWS 1000 1000" in out.stdout, out.stderr[-2000:]
    assert os.path.exists(root + "-failed")


def test_manifests_are_plain_json(spark, root):
    V.overwrite(days(spark, ["a"], "1"), root, ["day"])
    (name,) = [x for x in os.listdir(root + "/manifests") if not x.startswith(".")]
    with open(f"{root}/manifests/{name}") as f:
        found = json.load(f)
    assert found["number"] == 1 and list(found["parts"]) == ["day=a"]
