"""Quality classifier: hashed word n-gram logistic regression trained with FTRL.

Features of a text are hashed into ``2**BITS`` buckets: word unigrams and
bigrams (A-Z lower-cased), n-grams of word shapes (which character classes a
word holds, so that unseen words share features), and whether a bigram repeats
its word.  A feature's value is its share of the text's words, so a score is a
sparse dot product that does not depend on the text's length.

Training is follow-the-regularised-leader (FTRL-proximal, per-coordinate
rates, L1 and L2) over a bounded sample of labelled rows: the ``max_rows``
rows of smallest hashed id among those the caller labels.  The bound keeps the
one training task's memory fixed; scoring covers every row.

Defined results: a null or empty text scores the model's bias; a null label is
not learned from; several labels of one id count as their mean, 1 from 0.5 on;
repeated rows are scored alike; empty tables give no rows (without any label
the model is 0.5 everywhere); extra input columns are ignored by
``quality_scores`` and kept by ``keep_quality``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tarmac.llm import tokens as T
from tarmac.llm.tables import fold_of, giving_back, table

BITS = 18
#: Labelled rows that training reads at most (a bounded sample by hashed id).
MAX_TRAINING_ROWS = 12_000
THRESHOLD = 0.3
_SHAPE, _SHAPE_PAIR, _REPEAT = (np.uint64(x) for x in (11, 12, 13))

# Character classes of a word's shape, one bit each: lower case or non-ASCII,
# upper case, digit, control, and each ASCII sign by its own bit.
_CLASS = np.ones(256, np.uint64)
_CLASS[0x41:0x5B] = 2
_CLASS[0x30:0x3A] = 4
_CLASS[:0x20] = 8
_CLASS[[c for c in range(256) if not T.SPACE_SEPARATED[c]]] = 0
for _bit, _sign in enumerate("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", start=4):
    _CLASS[ord(_sign)] = np.uint64(1) << np.uint64(_bit)


def _buckets(h: np.ndarray) -> np.ndarray:
    return (T.mix(h) >> np.uint64(64 - BITS)).astype(np.int64)


def features(w: T.Words) -> tuple[np.ndarray, np.ndarray]:
    """``(text, bucket)`` of every feature occurrence, texts counted from 0."""
    if not len(w.hash):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    of = w.text_of
    shape = np.bitwise_or.reduceat(_CLASS[w.data], w.start)
    pair, at = T.ngrams(w, 2)
    shape_pair = T.combine(shape[at], shape[at + 1]) + _SHAPE_PAIR if len(at) else pair
    repeat = T.mix((w.hash[at] == w.hash[at + 1]).astype(np.uint64) + _REPEAT) if len(at) else pair
    texts = np.concatenate([of, of, of[at], of[at], of[at]])
    return texts, _buckets(np.concatenate([w.hash, T.mix(shape * np.uint64(64) + _SHAPE), pair, shape_pair, repeat]))


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse feature vectors of labelled texts (order, label, text)."""
    for batch in batches:
        for lo, hi, w in T.words_by_slice(batch.column("text")):
            texts, buckets = features(w)
            key, n = np.unique(texts * (1 << BITS) + buckets, return_counts=True)
            of, bucket = key >> BITS, key & ((1 << BITS) - 1)
            value = (n / np.maximum(w.counts, 1)[of]).astype(np.float32)
            cut = np.searchsorted(of, np.arange(hi - lo + 1))
            rows = [(bucket[a:b].astype(np.int32).tobytes(), value[a:b].tobytes()) for a, b in zip(cut[:-1], cut[1:], strict=True)]
            yield pa.record_batch(
                {
                    "order": batch.column("order")[lo:hi],
                    "label": batch.column("label")[lo:hi],
                    "bucket": pa.array([x[0] for x in rows], pa.binary()),
                    "value": pa.array([x[1] for x in rows], pa.binary()),
                }
            )


def ftrl(
    examples: list[tuple[np.ndarray, np.ndarray, int]],
    epochs: int = 4,
    alpha: float = 0.8,
    beta: float = 1.0,
    l1: float = 0.002,
    l2: float = 0.05,
    scale: float = 8.0,
) -> np.ndarray:
    """Weights after FTRL-proximal updates; the last weight is the bias.

    Values are multiplied by ``scale`` while learning; the returned weights
    apply to unscaled values.
    """
    z, n, w = np.zeros(2**BITS + 1), np.zeros(2**BITS + 1), np.zeros(2**BITS + 1)
    bias = np.array([2**BITS])
    for _ in range(epochs):
        for bucket, value, label in examples:
            i, x = np.concatenate([bucket, bias]), np.concatenate([value * scale, [1.0]])
            p = 1 / (1 + np.exp(-np.clip(w[i] @ x, -35, 35)))
            g = (p - label) * x
            more = n[i] + g * g
            z[i] += g - (np.sqrt(more) - np.sqrt(n[i])) / alpha * w[i]
            n[i] = more
            zi = z[i]
            w[i] = np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(more)) / alpha + l2))
    w[:-1] *= scale
    return w


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for batch in batches:
        for b, v, y in zip(batch["bucket"].to_pylist(), batch["value"].to_pylist(), batch["label"].to_pylist(), strict=True):
            rows.append((np.frombuffer(b, np.int32), np.frombuffer(v, np.float32), y))
    yield pa.record_batch({"weights": pa.array([ftrl(rows).astype(np.float32).tobytes()], pa.binary())})


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> np.ndarray:
    """Weights learned from ``labels`` (id, label) joined to ``docs`` (id, text).

    The sample has at most ``max_rows`` ids, and of each the row whose text has
    the smallest hash, so its broadcast, the training task and the weights have
    fixed bounds, and a repeated id counts once.
    """
    sample = (
        labels.filter(F.col("id").isNotNull() & F.col("label").isNotNull())
        .groupBy("id")
        .agg((F.avg("label") >= 0.5).cast("int").alias("label"))
        .withColumn("order", F.xxhash64("id"))
        .orderBy("order", "id")
        .limit(max_rows)
    )
    vectors = (
        docs.join(F.broadcast(sample), "id")
        .groupBy("order", "id", "label")
        .agg(F.min_by("text", F.xxhash64("text")).alias("text"))
        .select("order", "label", "text")
        .mapInArrow(giving_back(_featurise), "order long, label int, bucket binary, value binary")
        .repartition(1)
        .sortWithinPartitions("order", "bucket")
    )
    row = vectors.mapInArrow(giving_back(_train), "weights binary").first()
    return np.frombuffer(row[0], np.float32) if row else np.zeros(2**BITS + 1, np.float32)


def scores(text: pa.Array, weights: np.ndarray) -> np.ndarray:
    """The model's probability of label 1 for each text."""
    out = []
    for lo, hi, w in T.words_by_slice(text):
        texts, buckets = features(w)
        total = np.bincount(texts, weights[buckets], hi - lo) / np.maximum(w.counts, 1)
        out.append(1 / (1 + np.exp(-np.clip(total + weights[-1], -35, 35))))
    return np.concatenate(out) if out else np.zeros(0)


def add_scores(df: DataFrame, weights: np.ndarray, text: str = "text", score: str = "score") -> DataFrame:
    """``df`` with the score of its ``text`` column appended as ``score``."""
    shared = df.sparkSession.sparkContext.broadcast(weights)
    columns = df.columns
    at = columns.index(text)

    def score_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array(scores(batch.column(at), shared.value), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*columns, score])

    return df.mapInArrow(giving_back(score_batches), StructType([*df.schema.fields, StructField(score, DoubleType())]))


def _learned(docs: DataFrame, labels: DataFrame, max_rows: int) -> np.ndarray:
    labelled = labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("double").alias("label"))
    return train(docs.select(F.col("doc_id").alias("id"), "text"), labelled.filter(fold_of(F.col("id")) != 0), max_rows)


def quality_scores(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    Labels of fold 0 (crc32 of the id modulo 5) are never learned from.
    """
    rows = add_scores(docs.select("doc_id", "text"), _learned(docs, labels, max_rows))
    return rows.select(
        "doc_id",
        F.coalesce(fold_of(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that the model predicts as 1."""
    score = "score"
    while score in docs.columns:
        score = f"_{score}"
    return add_scores(docs, _learned(docs, labels, max_rows), score=score).filter(F.col(score) >= THRESHOLD).drop(score)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
