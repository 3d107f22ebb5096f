"""What each of five filters does in every order of applying them.

1. ``failed_filters`` marks for each document which filters it fails: four by
   its own text, the fifth (a copy of an earlier document) by the smallest id
   that holds the text.  Texts are compared by 128-bit digests, and a document
   is looked up among the first holders by (digest, id), so that a text which
   very many documents share is spread over tasks.
2. Documents are counted by (part, set of failed filters): at most 32 rows a
   part, whatever the number of documents.
3. A part's counts, reshaped to 2x2x2x2x2 (one axis a filter, index 1: fails),
   are contracted by ``einsum`` with one vector an axis (pass, fail or all) for
   every step of every order.

Defined results: a null text is the empty text (it has no words, so it fails A
only, and E where an earlier text is empty too); a null source is the part '';
a document without an id is nobody's copy and has no labels; rows that share an
id are documents of their own, the labels of an id hold for each of them, and
of those that share the text too none is a copy of the other; an id labelled
several times counts with the largest label; without documents there are no
rows; extra columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.tables import SEPARATORS, table, written
from tarmac.operators import left_join_unique

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
#: What a step's vectors select along an axis: documents that pass, that fail, or all.
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def text_conditions(text: Column) -> dict[str, Column]:
    """Failure conditions that a document's own text decides (``text`` not null)."""
    words = F.array_remove(F.split(text, SEPARATORS, -1), "")
    n_words, n_capitals = F.size(words), F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n_words < 50,
        "B": 100 * F.size(F.array_distinct(words)) < 65 * n_words,
        "C": 100 * n_capitals > 5 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def failed_filters(docs: DataFrame) -> DataFrame:
    """doc_id, part and one boolean a filter (true: fails) of every row of ``docs`` (doc_id, text, source)."""
    text = F.coalesce("text", F.lit(""))
    facts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("source", F.lit("")).alias("part"),
        F.unhex(F.md5(text.cast("binary"))).alias("digest"),
        *[c.alias(k) for k, c in text_conditions(text).items()],
    )
    facts = written(facts, "audit-facts")
    holders = facts.filter("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    holders = written(holders.withColumn("is_first", F.lit(True)), "audit-holders")
    found = facts.join(holders, ["digest", "doc_id"], "left")
    copy = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    return found.select("doc_id", "part", *"ABCD", copy.alias("E"))


def failure_counts(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """part, fails (bits, A the highest), n, good and toxic: documents by the set of filters they fail."""
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    marks = written(marks.filter("doc_id IS NOT NULL AND (good OR toxic)"), "audit-labels")
    bits = sum(F.col(f).cast("int") * (1 << (len(FILTERS) - 1 - i)) for i, f in enumerate(FILTERS))
    rows = failed.select("doc_id", "part", bits.alias("fails"))
    found = left_join_unique(rows, marks, "doc_id", ["part", "fails"])
    return found.groupBy("part", "fails").agg(
        F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")
    )


def _step_vectors(along_filter: tuple, along_earlier: tuple, along_later: tuple) -> list[np.ndarray]:
    """For each axis, a row of its vector at every (order, step)."""
    out = []
    for f in FILTERS:
        rows = []
        for order in ORDERS:
            own = order.index(f)
            rows += [along_filter if own == step else along_earlier if own < step else along_later for step in range(len(order))]
        out.append(np.array(rows, np.int64))
    return out


_REMOVED = _step_vectors(FAIL, PASS, ALL)
_KEPT = _step_vectors(PASS, PASS, ALL)
_FAILING = _step_vectors(FAIL, ALL, ALL)
_ONLY = _step_vectors(FAIL, PASS, PASS)


def contract(tensor: np.ndarray, vectors: list[np.ndarray]) -> np.ndarray:
    """Documents that each (order, step) selects of a 2x2x2x2x2 tensor."""
    return np.einsum("abcde,na,nb,nc,nd,ne->n", tensor, *vectors, optimize="greedy")


def audit_part(fails: np.ndarray, n: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> dict[str, np.ndarray]:
    """MEASURES of one part at every (order, step), from its counts by set of failed filters."""
    tensors = []
    for values in (n, good, toxic):
        flat = np.zeros(1 << len(FILTERS), np.int64)
        np.add.at(flat, fails, values)
        tensors.append(flat.reshape((2,) * len(FILTERS)))
    every, of_good, of_toxic = tensors
    removed = contract(every, _REMOVED)
    letter = np.array([FILTERS.index(f) for order in ORDERS for f in order])
    by_letter = np.zeros(len(FILTERS), np.int64)
    np.add.at(by_letter, letter, removed)
    return {
        "kept": contract(every, _KEPT),
        "removed": removed,
        "redundant": contract(every, _FAILING) - removed,
        "unique_fails": contract(every, _ONLY),
        "good_lost": contract(of_good, _REMOVED),
        "toxic_lost": contract(of_toxic, _REMOVED),
        "shapley": by_letter[letter],
    }


def _audit(rows: pa.Table) -> pa.Table:
    found = audit_part(*(rows.column(c).to_numpy() for c in ("fails", "n", "good", "toxic")))
    steps = len(ORDERS) * len(FILTERS)
    return pa.table(
        {
            "part": pa.array([rows.column("part")[0].as_py()] * steps, pa.string()),
            "filter_order": pa.array(np.repeat(ORDERS, len(FILTERS)), pa.string()),
            "step": pa.array(np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(ORDERS))),
            **{k: pa.array(v, pa.int64()) for k, v in found.items()},
        }
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step: filter_order, step and MEASURES.

    A group handed to ``_audit`` holds at most 32 rows.
    """
    counts = written(failure_counts(failed_filters(docs), labels), "audit-counts")
    kinds = ", ".join(f"{m} long" for m in MEASURES)
    return counts.groupBy("part").applyInArrow(_audit, f"part string, filter_order string, step int, {kinds}")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
), cut AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS holder FROM texts
), marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), failed AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(words) < 50 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > holder THEN 'E' ELSE '' END AS fails
  FROM cut LEFT JOIN marks USING (doc_id)
), counts AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, fails
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.x NOT IN (b.x, c.x, d.x, e.x) AND b.x NOT IN (c.x, d.x, e.x) AND c.x NOT IN (d.x, e.x) AND d.x <> e.x
), steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, step, 1) AS f,
    substr(filter_order, 1, step - 1) AS earlier, substr(filter_order, 1, step) AS so_far
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step) AS numbers
), taken AS (
  SELECT part, filter_order, step, f,
    sum(CASE WHEN translate(fails, so_far, '') = fails THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN contains(fails, f) AND translate(fails, earlier, '') = fails THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN contains(fails, f) AND translate(fails, earlier, '') <> fails THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = f THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN contains(fails, f) AND translate(fails, earlier, '') = fails THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN contains(fails, f) AND translate(fails, earlier, '') = fails THEN toxic ELSE 0 END) AS toxic_lost
  FROM counts, steps GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM taken
"""
