"""The classifier: FTRL against its definition, held-out accuracy, edge cases."""

import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tarmac.llm import quality_classifier as Q
from tarmac.llm import tokens as T
from tarmac.llm.tables import table

from ..conftest import SF_ORACLE, SF_SMALL

DOCS = "doc_id long, text string"
LABELS = "doc_id long, quality int, toxic int"


def plain_ftrl(examples, epochs, alpha=0.8, beta=1.0, l1=0.002, l2=0.05, scale=8.0):
    """Per-coordinate FTRL-proximal, one number at a time."""
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(epochs):
        for bucket, value, label in examples:
            x = {int(i): float(v) * scale for i, v in zip(bucket, value)} | {2**Q.BITS: 1.0}
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-sum(w[i] * x[i] for i in x)))
            for i, v in x.items():
                g = (p - label) * v
                old = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / alpha * w[i]
                n[i] = old + g * g
    return {i: weight(i) * (1 if i == 2**Q.BITS else scale) for i in z}


def test_ftrl_equals_its_definition():
    rng = np.random.default_rng(2)
    examples = [
        (np.unique(rng.integers(0, 50, 8)).astype(np.int32), None, int(rng.integers(0, 2))) for _ in range(40)
    ]
    examples = [(b, rng.random(len(b)).astype(np.float32), y) for b, _, y in examples]
    got, want = Q.ftrl(examples, epochs=2), plain_ftrl(examples, 2)
    assert {i for i in np.flatnonzero(got)} <= set(want)
    for i, w in want.items():
        assert got[i] == pytest.approx(w, rel=1e-5, abs=1e-7)


def test_features_are_counted_within_texts():
    w = T.words(*T.text_bytes(pa.array(["a b a b", "a", "", None, "B! B!"])))
    texts, buckets = Q.features(w)
    assert np.bincount(texts, minlength=5).tolist() == [2 * 4 + 3 * 3, 2, 0, 0, 2 * 2 + 3]
    assert ((0 <= buckets) & (buckets < 2**Q.BITS)).all()
    same = Q.scores(pa.array(["x y z", "X Y Z"]), np.zeros(2**Q.BITS + 1, np.float32))
    assert same.tolist() == [0.5, 0.5]


def test_query_on_held_out_labels(spark):
    rows = Q.op5_quality_classifier(spark, SF_ORACLE)
    labels = table(spark, SF_ORACLE, "labels")
    scored = rows.join(labels, "doc_id").filter("held_out").collect()
    assert rows.count() == table(spark, SF_ORACLE, "documents").count()
    assert sum(r.predicted == r.quality for r in scored) / len(scored) > 0.93
    for r in rows.collect():
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_held_out_labels_and_other_columns_have_no_effect(spark):
    docs, labels = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    flipped = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    renamed = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string"), "score": F.lit(3), "label": F.lit("q")})
    usual = sorted(map(tuple, Q.quality_scores(docs, labels).collect()))
    assert sorted(map(tuple, Q.quality_scores(renamed, flipped).collect())) == usual


def test_edge_cases(spark):
    docs = spark.createDataFrame(
        [(1, "good words here"), (2, "bad ### $$$"), (3, None), (3, ""), (None, "good"), (5, "word " * 50_000), (2, "bad ### $$$")], DOCS
    )
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 0, 1), (3, None, None), (None, 1, 0)], LABELS)
    rows = Q.quality_scores(docs, labels).collect()
    assert len(rows) == 7
    empty = [r.score for r in rows if r.doc_id == 3]
    assert empty[0] == empty[1]
    assert len({r.score for r in rows if r.doc_id == 2}) == 1
    nobody = spark.createDataFrame([], LABELS)
    assert {r.score for r in Q.quality_scores(docs, nobody).collect()} == {0.5}
    assert Q.quality_scores(spark.createDataFrame([], DOCS), labels).collect() == []


def test_keep_quality_keeps_columns(spark):
    docs = table(spark, SF_SMALL, "documents").withColumns({"score": F.lit("s"), "_score": F.lit(1)})
    labels = table(spark, SF_SMALL, "labels")
    kept = Q.keep_quality(docs, labels)
    assert kept.columns == docs.columns
    predicted = Q.quality_scores(docs, labels).filter("predicted = 1").select("doc_id").collect()
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(r.doc_id for r in predicted)


def test_the_sample_bound_is_kept(spark):
    docs, labels = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels")
    few = Q.train(docs.select(F.col("doc_id").alias("id"), "text"), labels.select(F.col("doc_id").alias("id"), F.col("quality").alias("label")), 5)
    assert len(few) == 2**Q.BITS + 1 and np.isfinite(few).all()


def test_a_repeated_id_is_learned_once(spark):
    docs = spark.createDataFrame([(i, f"text number {i} " + ("good words" if i % 2 else "poor thing")) for i in range(40)], "id long, text string")
    labels = docs.select("id", (F.col("id") % 2).cast("double").alias("label"))
    again = docs.filter("id = 3").crossJoin(spark.range(50).select(F.lit(1).alias("x"))).drop("x")
    assert np.array_equal(Q.train(docs.union(again), labels), Q.train(docs, labels))
