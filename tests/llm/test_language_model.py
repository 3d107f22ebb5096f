"""Base scores against brute force; the model against its own exact counterpart."""

import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tarmac.llm import count_filter as C
from tarmac.llm import language_model as L
from tarmac.llm.tables import table

from ..conftest import SF_SMALL

SCHEMA = "doc_id long, text string"


def _tokens(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + ["</end>"]


def _fold(doc):
    return None if doc is None else zlib.crc32(str(doc).encode()) % 5


def brute_force(docs):
    """Rows of the query's exact columns, and the exact model's score."""
    one, two, context = Counter(), Counter(), Counter()
    for doc, text in docs:
        if _fold(doc) not in (None, 1):
            t = _tokens(text)
            one.update(t)
            two.update(zip(["<start>", *t], t))
            context.update(["<start>", *t[:-1]])
            context["</end>"] += 1
    n, v = sum(one.values()), len(one)
    weight = 1 - sum(1 for c in two.values() if c == 1) / n if n else 0
    out = []
    for doc, text in docs:
        t = _tokens(text)
        alone = [(one[x] + 0.5) / (n + 0.5 * (v + 1)) for x in t]
        base, score = sum(math.log10(p) for p in alone), 0.0
        for before, x, p in zip(["<start>", *t], t, alone):
            w = weight if context[before] else 0.0
            score += math.log10(w * two[before, x] / max(context[before], 1) + (1 - w) * p)
        out.append((doc, _fold(doc) == 1, len(t), sum(one[x] > 0 for x in t), n, base, score))
    return out


def check(rows, expected, tolerance):
    key = lambda r: (str(r[0]), r[2], r[5])
    rows, expected = sorted(map(tuple, rows), key=key), sorted(expected, key=key)
    assert [r[:5] for r in rows] == [r[:5] for r in expected]
    assert np.allclose([r[5] for r in rows], [r[5] for r in expected], rtol=1e-9, atol=1e-9)
    for got, want in zip(rows, expected):
        assert abs(got[6] - want[6]) <= tolerance * want[2] + 1e-9, (got, want)


def test_query_against_brute_force(spark):
    docs = [tuple(r) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    rows = L.op2_language_model(spark, SF_SMALL).collect()
    check(rows, brute_force(docs), 0.12)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


CASES = [(0, None), (1, ""), (2, "a b a b"), (3, "a b c"), (3, "a b c"), (4, "A\x1cB c"), (None, "z z"), (5, "x " * 5000), (6, "a x é É")]


def test_edge_cases(spark):
    frame = spark.createDataFrame(CASES, SCHEMA).withColumns({"word": F.lit(1), "block": F.lit("x"), "n": F.lit(2)})
    check(L.language_model_scores(frame).collect(), brute_force(CASES), 0.12)


def test_without_training_text(spark):
    held = [i for i in range(100) if _fold(i) == 1][:3]
    docs = [(i, "a b") for i in held]
    rows = L.language_model_scores(spark.createDataFrame(docs, SCHEMA)).collect()
    check(rows, brute_force(docs), 1e-6)
    assert L.language_model_scores(spark.createDataFrame([], SCHEMA)).collect() == []


def test_filter_reads_back_levels():
    rng = np.random.default_rng(1)
    h = np.unique(rng.integers(0, 2**63, 20000, dtype=np.uint64) * np.uint64(2))
    n = rng.zipf(1.4, len(h)).clip(1, 10**9)
    f = C.CountFilter(3, 18, 4)
    segment, key = C.split_key(h, 3)
    level = C.level_of(n)
    f.data = np.frombuffer(b"".join(f.segment(key[segment == s], level[segment == s]) for s in range(8)), np.uint8)
    want = C.MIDDLE[level]
    got = f.counts(h)
    assert (got >= want).all()  # errors are overestimates only
    assert (got == want).mean() > 0.8
    absent = f.counts(rng.integers(0, 2**63, 20000, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
    assert (absent == 0).mean() > 0.8


def test_filter_size_follows_insertions():
    sizes = np.zeros(len(C.STARTS) + 1, np.int64)
    sizes[:5] = [5_000_000, 1_000_000, 100_000, 10_000, 1000]  # level 0: asked for, never learned
    inserted = 1_000_000 + 2 * 100_000 + 3 * 10_000 + 4 * 1000
    for times in (1, 1000):
        plan = L._plan_filter(sizes * times)
        assert 12 * inserted * times <= 1 << plan.bits < 24 * inserted * times


def test_many_blocks_and_segments(spark, monkeypatch):
    """Documents of many small blocks, n-grams of many segments: the same scores."""
    docs = [tuple(r) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    monkeypatch.setattr(L, "BLOCK_BYTES", 1 << 14)
    monkeypatch.setattr(L, "SEGMENT_BYTES", 1 << 13)
    check(L.op2_language_model(spark, SF_SMALL).collect(), brute_force(docs), 0.12)
    assert _blocks(table(spark, SF_SMALL, "documents")).count() > 10


def _blocks(frame):
    return L.blocks_of(frame.withColumns({"held_out": F.lit(False), "learn": F.lit(True)}))


def test_the_filter_grows_with_the_text(spark, monkeypatch):
    monkeypatch.setattr(L, "SEGMENT_BYTES", 1 << 12)
    words = F.transform(F.sequence(F.lit(1), F.lit(100)), lambda i: F.xxhash64(i, "id").cast("string"))
    kept = []
    for n in (100, 400):
        model, segments = L.train(_blocks(spark.range(n).select(F.col("id").alias("doc_id"), F.concat_ws(" ", words).alias("text"))))
        kept.append(segments.filter("block IS NULL").agg(F.count("*"), F.sum(F.length("data"))).first())
        # Every bigram of these texts is seen once, but for those of a text's end.
        assert model.bigram_weight < 0.01 and model.tokens == 101 * n and model.distinct == 100 * n + 1
    assert kept[1][0] == 4 * kept[0][0] and kept[1][1] > 3 * kept[0][1]


def test_a_repeated_id_and_empty_texts_are_cut_into_blocks(spark, monkeypatch):
    """Blocks are bounded by text and by rows, whatever the ids."""
    monkeypatch.setattr(L, "BLOCK_BYTES", 1 << 12)
    rows = spark.range(60_000).coalesce(1).select(F.lit(7).cast("long").alias("doc_id"), F.lit("").alias("text"))
    blocks = _blocks(rows.withColumn("text", F.when(F.rand(1) < 0.5, F.lit("a b c")).otherwise("")))
    assert blocks.select(F.explode("n").alias("n")).agg(F.count("*"), F.min("n"), F.max("n")).first() == (60_000, 1, 4)
    sizes = [r[0] for r in blocks.select("size").collect()]
    assert len(sizes) == blocks.select("block").distinct().count() > 5
