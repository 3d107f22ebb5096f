"""Decontamination against brute force; the FM-index against plain search."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import decontaminate as D
from tarmac.llm.fm_index import FMIndex
from tarmac.llm.tables import table

from ..conftest import SF_SMALL

DOCS = "doc_id long, text string"
ITEMS = "item_id long, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def brute_force(docs, items, window=13):
    owners = {}
    for item, text in items:
        w = _words(text)
        for i in range(max(len(w) - window, 0) + 1 if w else 0):
            owners.setdefault(tuple(w[i : i + window]), set()).add(item)
    lengths = {len(p) for p in owners}
    out = []
    for doc, text in docs:
        w = _words(text)
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                own = owners.get(tuple(w[i : i + n]))
                if own:
                    hit.update(range(i, i + n))
                    found |= own
        ids = sorted(str(x) for x in found if x is not None)
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(ids), digest, 20 * len(hit) >= len(w) > 0 < len(hit)))
    return sorted(out, key=str)


def run(spark, docs, items, **more):
    rows = D.contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), **more).drop("spans").collect()
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize("n,symbols", [(1, 2), (50, 3), (400, 4), (3000, 40)])
def test_index_finds_every_occurrence(n, symbols):
    rng = np.random.default_rng(n)
    text = np.append(rng.integers(1, symbols, n), 0)
    text[n // 2 : n // 2 + n // 4] = text[: n // 4]  # a long repeat
    index = FMIndex(text, symbols)
    for length in (1, 2, 5):
        if n < length:
            continue
        phrases = np.unique(np.stack([text[i : i + length] for i in rng.integers(0, n - length + 1, 30)]), axis=0)
        which, lo, hi = index.search(phrases.ravel(), np.arange(len(phrases)) * length, length)
        assert which.tolist() == list(range(len(phrases)))
        for p, a, b in zip(phrases, lo, hi):
            expected = [i for i in range(n - length + 1) if (text[i : i + length] == p).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == expected


def test_query_equals_brute_force_on_the_driver_tables(spark):
    docs = [tuple(r) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in table(spark, SF_SMALL, "benchmark").select("item_id", "text").collect()]
    got = sorted((tuple(r) for r in D.op10_decontamination(spark, SF_SMALL).collect()), key=str)
    expected = brute_force(docs, items)
    assert got == expected
    assert any(r[5] for r in expected)


PHRASE = " ".join(f"w{i}" for i in range(13))
CASES = [
    (1, None),
    (2, ""),
    (3, "... --- !!"),
    (4, PHRASE),
    (5, f"a b {PHRASE.upper()}, c d {PHRASE} e"),
    (6, "x " * 2000 + PHRASE),
    (7, "Too Short"),
    (7, "Too Short"),
    (8, " ".join(f"w{i}" for i in range(12))),
    (None, PHRASE),
    (9, "é" + PHRASE),
    (10, "w0 " * 30 + "deux mots"),
]
ITEM_CASES = [(1, PHRASE), (2, PHRASE + " w13"), (3, "too short"), (4, None), (5, " .,"), (3, "deux mots"), (None, "w0 w0"), (10, PHRASE)]


def test_edge_cases(spark):
    assert run(spark, CASES, ITEM_CASES) == brute_force(CASES, ITEM_CASES)


def test_small_blocks_and_pieces_find_the_same(spark, monkeypatch):
    docs = [(i, f"{'pad ' * i}{PHRASE} {'w0 ' * i}") for i in range(20)]
    found = D.find_spans(
        spark.createDataFrame(docs, DOCS), D.items_of(spark.createDataFrame(ITEM_CASES, ITEMS)), block_bytes=30
    ).collect()
    whole = D.find_spans(spark.createDataFrame(docs, DOCS), D.items_of(spark.createDataFrame(ITEM_CASES, ITEMS))).collect()
    assert [tuple(r) for r in sorted(found)] == [tuple(r) for r in sorted(whole)]
    import pyarrow as pa

    from tarmac.llm import tokens as T

    phrases = D.Phrases([("1", PHRASE), ("2", "w0 w0 w0")])
    w = T.words(*T.text_bytes(pa.array([t for _, t in docs])), T.ALPHANUMERIC)
    hit, items = phrases.find(w)
    monkeypatch.setattr(D, "SHARD_WORDS", 7)
    hit_by_piece, items_by_piece = phrases.find(w)
    assert hit.tolist() == hit_by_piece.tolist() and items == items_by_piece


def test_empty_tables(spark):
    assert run(spark, [], [(1, PHRASE)]) == []
    assert run(spark, [(1, PHRASE)], []) == brute_force([(1, PHRASE)], [])


def test_drop_and_cut_keep_columns(spark):
    docs = spark.createDataFrame(CASES, DOCS).withColumns({"found_spans": F.lit("x"), "items": F.lit(1), "n_words": F.lit(2)})
    items = spark.createDataFrame([(1, PHRASE)], ITEMS).withColumn("id", F.lit(3))
    kept = D.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    expected = [r[0] for r in brute_force(CASES, [(1, PHRASE)]) if not r[5]]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(expected, key=str)
    cut = {r.doc_id: r.text for r in D.cut_spans(docs, items).collect()}
    assert cut[4] == "" and cut[5] == "a b , c d  e" and cut[7] == "Too Short" and cut[1] is None
