"""Lexical search against SQL, and against scoring every document."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import lexical_search as L
from tarmac.llm.tables import ship

from ..conftest import SF_ORACLE, SF_SMALL
from .sql import compare

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


@pytest.mark.parametrize("sf_dir", [SF_SMALL, SF_ORACLE])
def test_query_equals_sql(spark, sf_dir):
    compare(spark, "op11_lexical_search", sf_dir)


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(docs, items, top=10):
    bags = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n, length = len(bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        found = []
        for doc_id, bag in bags:
            m = 10 + (90 * bag.total() * n) // length
            w = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in set(terms(text)) if t in bag}
            score = sum(w[t] * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in w)
            if score > 0:
                found.append((-score, doc_id is None, doc_id))
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, rank, x[2], -x[0]) for rank, x in enumerate(found[:top], 1)]
    return out


def corpus(n=700, seed=3):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(400)]
    share = 1 / np.arange(1, 401)
    docs = []
    for i in range(n):
        topic = rng.integers(0, 8) * 40
        picked = [words[(j + topic) % 400] for j in rng.choice(400, 5 + i % 90, p=share / share.sum())]
        docs.append((i, " ".join(picked)))
    items = [(i, " ".join(rng.choice(words, 12))) for i in range(30)]
    return docs, items


def as_rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_equals_scoring_every_document(spark, monkeypatch):
    ship(spark)
    docs, items = corpus()
    docs += [(i, docs[i % 50][1]) for i in range(2000, 2120)]  # copies: equal scores
    frames = spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS)
    assert as_rows(L.lexical_search(*frames)) == sorted(plain_search(docs, items), key=str)
    assert as_rows(L.lexical_search(*frames, top=3, block_bytes=300)) == sorted(plain_search(docs, items, 3), key=str)


def test_blocks_are_skipped_only_below_the_tenth_score(monkeypatch):
    """In one shard, with short lists' blocks, long documents, and all documents scored beside."""
    monkeypatch.setattr(L, "LIST_BLOCK", 8)
    monkeypatch.setattr(L, "LONG_TERMS", 60)
    docs, items = corpus(1500, 5)
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, text in items for t in terms(text)}))}
    bags = [Counter(terms(t)) for _, t in docs]
    n, length = len(bags), sum(b.total() for b in bags)
    df = Counter(t for b in bags for t in b)
    weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in vocabulary])
    own = [sorted((vocabulary[t], c) for t, c in b.items() if t in vocabulary) for b in bags]
    keep = [i for i, x in enumerate(own) if x]
    arrays = L.build_shard(
        np.array([bags[i].total() for i in keep]),
        np.array([len(own[i]) for i in keep]),
        np.array([t for i in keep for t, _ in own[i]]),
        np.array([c for i in keep for _, c in own[i]]),
        weight,
        n,
        length,
    )
    searcher = L.Searcher(L.Shard(np.array(keep), np.zeros(len(keep), bool), **arrays), weight)
    want = plain_search(docs, items)
    for item, text in items:
        found, scores = searcher.best(np.array(sorted({vocabulary[t] for t in terms(text)})))
        assert [(item, r, keep[d], s) for r, (d, s) in enumerate(zip(found.tolist(), scores.tolist()), 1)] == [x for x in want if x[0] == item]
    assert searcher.skipped > searcher.visited > 0


EDGE = [
    (1, None),
    (2, ""),
    (3, " .,; "),
    (4, "Straße ÉCOLE école 12"),
    (5, "ECOLE École 12 12"),
    (6, "long " * 30_000 + "needle"),
    (4, "needle in a stack"),
    (4, "needle in a stack"),
    (None, "needle"),
    (None, "needle"),
    (7, "x" * 100_000),
]


def test_edge_cases(spark):
    ship(spark)
    items = [(1, "needle"), (1, "NEEDLE, needle!"), (2, None), (3, ""), (None, "école 12"), (4, "absent"), (5, "x" * 100_000), (6, "in a long Stack")]
    docs = spark.createDataFrame(EDGE, DOCS).withColumns({"item": F.lit("q"), "n": F.lit(1), "score": F.lit(2), "item_id": F.lit(3)})
    queries = spark.createDataFrame(items, ITEMS).withColumns({"item": F.lit("q"), "doc_id": F.lit(1), "rank": F.lit("r")})
    assert as_rows(L.lexical_search(docs, queries)) == sorted(plain_search(EDGE, items), key=str)
    none = L.lexical_search(spark.createDataFrame([], DOCS), queries)
    assert none.collect() == [] and none.columns == ["item_id", "rank", "doc_id", "score"]
    assert L.lexical_search(docs, spark.createDataFrame([], ITEMS)).collect() == []
