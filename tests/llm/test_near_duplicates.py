"""Near-duplicates against brute force over all pairs, and components against union-find."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tarmac.llm import near_duplicates as N
from tarmac.llm.components import components
from tarmac.llm.tables import table

from ..conftest import SF_SMALL

SCHEMA = "doc_id long, text string"


def _find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def brute_force(docs, k):
    """(doc_id, n_shingles, component_id, kept) by comparing all pairs of sets."""
    sets = []
    for _, text in docs:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", lower)
        sets.append({tuple(w[i : i + k]) for i in range(max(len(w) - k, 0) + 1)} if w else set())
    parent = {d: d for d, _ in docs if d is not None}
    for i, (a, _) in enumerate(docs):
        for j in range(i):
            b = docs[j][0]
            both = len(sets[i] & sets[j])
            if both and None not in (a, b) and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                x, y = _find(parent, a), _find(parent, b)
                parent[max(x, y)] = min(x, y)
    out = []
    for (d, _), s in zip(docs, sets):
        component = None if d is None else _find(parent, d)
        out.append((d, len(s), component, d is None or d == component))
    return sorted(out, key=str)


def run(spark, docs, k=5):
    rows = N.near_duplicates(spark.createDataFrame(docs, SCHEMA), k).collect()
    return sorted((tuple(r) for r in rows), key=str)


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in N.op4_near_duplicates(spark, SF_SMALL).collect()), key=str)
    assert got == brute_force(docs, 4)
    assert any(not r[3] for r in got)


def family(seed, n, words=150, most=0.12):
    """Copies of one text, each with words of its own at a random rate."""
    rng = random.Random(seed)
    base = [f"b{seed}w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for i in range(n):
        rate = rng.uniform(0, most)
        out.append(" ".join(f"x{i}y{j}" if rng.random() < rate else w for j, w in enumerate(base)))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_families_of_near_copies(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(N, "BLOCK", 4)
        monkeypatch.setattr(N, "RARE", 2)
    passage = " ".join(f"p{i}" for i in range(80))
    texts = family(1, 60) + family(2, 40, most=0.03) + [f"{passage} {' '.join(f't{i}u{j}' for j in range(60))}" for i in range(30)]
    texts += [texts[0]] * 20 + ["short one"] * 3 + ["short one more"]
    random.Random(5).shuffle(texts)
    docs = list(enumerate(texts, start=7))
    got = run(spark, docs)
    assert got == brute_force(docs, 5)
    assert 2 < len({r[2] for r in got}) < len(docs)


def test_signatures_of_classes_alone_in_their_buckets_are_not_dealt(spark, monkeypatch):
    texts = family(3, 20) + [" ".join(f"single{i}n{j}" for j in range(40)) for i in range(200)]
    dealt, bands_read = [], []
    for name in ("_first_members", "_rest_of_buckets"):

        def counted(rows, *others, call=getattr(N, name)):
            dealt.append(others[-1].count())
            return call(rows, *others)

        monkeypatch.setattr(N, name, counted)
    written = N.written

    def noted(df, name, *options):
        bands_read.extend([name] * any("/near-bands-" in x for x in df.inputFiles()))
        return written(df, name, *options)

    monkeypatch.setattr(N, "written", noted)
    docs = list(enumerate(texts))
    assert run(spark, docs) == brute_force(docs, 5)
    assert len(dealt) == 2 and max(dealt) < 40  # before: 220, all classes
    assert len(bands_read) == 2  # before: 3


EDGES = [
    (1, None),
    (2, ""),
    (3, " \n"),
    (4, "One Two"),
    (5, "one two"),
    (6, "one two three"),
    (7, "a b c d e f"),
    (7, "a b c d e f"),
    (8, "A B C D E F"),
    (None, "a b c d e f"),
    (9, "long " + " ".join(f"n{i}" for i in range(30_000))),
    (10, " ".join(f"n{i}" for i in range(30_000)) + " tail"),
    (11, "same same same same same same same"),
    (12, "same same same same same"),
    # rows of one id with other texts link what each of them links
    (20, "q w e r t z u i o p"),
    (21, "q w e r t z u i o p"),
    (20, "y x c v b n m k l j"),
    (19, "y x c v b n m k l j"),
    (-3, "y x c v b n m k l j"),
]


def test_edge_cases(spark):
    assert run(spark, EDGES) == brute_force(EDGES, 5)
    assert run(spark, []) == []
    assert run(spark, EDGES[:3]) == brute_force(EDGES[:3], 5)


def test_keep_one_of_each(spark):
    frame = spark.createDataFrame(EDGES, SCHEMA).withColumns({"component": F.lit("x"), "id": F.lit(1), "rep": F.lit(2)})
    kept = N.keep_one_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((r[0] for r in brute_force(EDGES, 5) if r[3]), key=str)


@pytest.mark.parametrize("shape", ["path", "star", "random", "cycle", "none"])
def test_components_equal_union_find(spark, shape):
    rng = random.Random(3)
    links = {
        "path": [(i, i + 1) for i in range(70)] + [(200, 199), (199, 198)],
        "star": [(500, i) for i in range(300)] + [(7, 7)],
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(200)],
        "cycle": [(i, (i + 1) % 30) for i in range(30)] * 2,
        "none": [],
    }[shape]
    parent = {x: x for link in links for x in link}
    for a, b in links:
        x, y = _find(parent, a), _find(parent, b)
        parent[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert sorted(map(tuple, got)) == sorted((x, _find(parent, x)) for x in linked)
