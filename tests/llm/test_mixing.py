"""Mixing against SQL, and against a plain-Python filling of targets."""

import pytest
from pyspark.sql import functions as F

from tarmac.llm import mixing as M

from ..conftest import SF_ORACLE, SF_SMALL
from .sql import compare

SCHEMA = "doc_id long, text string, source string"


@pytest.mark.parametrize("sf_dir", [SF_SMALL, SF_ORACLE])
def test_query_equals_sql(spark, sf_dir):
    compare(spark, "op8_mixing", sf_dir)


def plain_targets(sizes):
    """Share, cap, and share the excess again until no target is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    budget, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = budget - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            return {**share, **fixed}
        fixed |= {s: 2.0 * sizes[s] for s in over}


def docs(n=600):
    sources = ["a"] * 300 + ["b"] * 40 + [None] * 60 + ["zzz"] * 150 + ["é"] * 49 + ["one"]
    return [(i, "word " * (1 + i * 37 % 50), sources[i % len(sources)]) for i in range(n)]


def test_targets_and_taken_words(spark):
    rows = M.mixture(spark.createDataFrame(docs(), SCHEMA)).collect()
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
    want = plain_targets(sizes)
    for s, size in sizes.items():
        own = [r for r in rows if r.source == s]
        assert all(r.source_size == size and abs(r.target - want[s]) < 1e-6 for r in own)
        assert abs(sum(r.taken for r in own) - want[s]) <= max(r["size"] for r in own)
        assert all(0 <= r.taken <= 2 * r["size"] for r in own)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, M.mixture(spark.createDataFrame(docs(), SCHEMA).repartition(5)).collect()))


def test_edge_cases(spark):
    cases = [(1, None, "a"), (2, "", "a"), (3, " \n", None), (None, "x y", "b"), (4, "x y z", "b"), (4, "x y z", "b"), (5, "long " * 9000, "c")]
    rows = M.mixture(spark.createDataFrame(cases, SCHEMA).withColumns({"size": F.lit("q"), "rest": F.lit(1)})).collect()
    assert len(rows) == len(cases)
    by = {(r.doc_id, r.source): r for r in rows}
    assert by[1, "a"].target == 0 and by[1, "a"].taken == 0 and by[3, None].target == 0
    assert by[4, "b"].source_size == 8
    assert M.mixture(spark.createDataFrame([], SCHEMA)).collect() == []
    assert {r.taken for r in M.mixture(spark.createDataFrame(cases[:3], SCHEMA)).collect()} == {0}


def test_mix_repeats_rows_and_keeps_columns(spark):
    frame = spark.createDataFrame(docs(), SCHEMA).withColumns({"rounds": F.lit("x"), "threshold": F.lit("y"), "mix_of": F.lit(0)})
    mixed = M.mix(frame)
    assert mixed.columns == frame.columns
    taken = {r.doc_id: r.times for r in M.mixture(frame).collect()}
    got = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert got == {k: v for k, v in taken.items() if v}


@pytest.mark.parametrize("same_text", [True, False])
def test_a_source_of_equal_ids_meets_its_target(spark, same_text):
    """Rows that share an id, null or not, and even whole texts, are taken one by one."""
    rows = [(None, "word " * 5 if same_text else f"w{i} " * (1 + i % 9), "a") for i in range(400)]
    rows += [(7, "word " * 6 if same_text else f"v{i} " * (1 + i % 9), "b") for i in range(400)] + [(i, "word " * 5, "c") for i in range(100)]
    frame = spark.createDataFrame(rows, SCHEMA)
    out = M.mixture(frame).collect()
    assert len(out) == len(rows)
    for s in "abc":
        own = [r for r in out if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r["size"] for r in own) / 2 + 1e-6
    again = M.mixture(frame.repartition(7)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    mixed = M.mix(frame)
    words = {r.source: r.n for r in mixed.groupBy("source").agg(F.sum(M._size(F.col("text"))).alias("n")).collect()}
    assert words == {s: sum(r.taken for r in out if r.source == s) for s in "abc"}


def test_only_the_boundary_bucket_is_summed_again(spark, monkeypatch):
    rows = spark.createDataFrame([(i, "word " * 7, "a" if i % 3 else "b") for i in range(20_000)], SCHEMA)
    sizes, plain = [], M._in_boundary
    monkeypatch.setattr(M, "_in_boundary", lambda *a: (sizes.append((r := plain(*a)).count()), r)[1])
    M.mixture(rows).collect()
    assert len(sizes) == M.LEVELS - 1 and sizes[0] < 100 and sizes == sorted(sizes, reverse=True)
