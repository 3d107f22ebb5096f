"""The filter audit against SQL, and against applying the filters one by one."""

from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tarmac.llm import filter_audit as A

from ..conftest import SF_ORACLE, SF_SMALL
from .sql import compare

DOCS = "doc_id long, text string, source string"
LABELS = "doc_id long, quality int, toxic int"


@pytest.mark.parametrize("sf_dir", [SF_SMALL, SF_ORACLE])
def test_query_equals_sql(spark, sf_dir):
    columns, rows = compare(spark, "op13_filter_audit", sf_dir)
    parts = {r[columns.index("part")] for r in rows}
    assert len(rows) == 600 * len(parts)


def plain_failures(docs):
    out = []
    for doc_id, text, _ in docs:
        text = text or ""
        words = [w for w in text.translate({c: " " for c in range(9, 14)}).split(" ") if w]
        failed = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": doc_id is not None and any(d is not None and d < doc_id and (t or "") == text for d, t, _ in docs),
        }
        out.append({k for k, v in failed.items() if v})
    return out


def plain_audit(docs, labels):
    """Each order applied to the documents themselves."""
    failures = plain_failures(docs)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    out = {}
    for part in {s or "" for *_, s in docs}:
        own = [(d, f) for (d, _, s), f in zip(docs, failures, strict=True) if (s or "") == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone = [(d, x) for d, x in left if f in x]
                left = [(d, x) for d, x in left if f not in x]
                total[f] += len(gone)
                out[part, order, step] = [
                    len(left),
                    len(gone),
                    sum(f in x for _, x in own) - len(gone),
                    sum(x == {f} for _, x in own),
                    sum(d in good for d, _ in gone),
                    sum(d in toxic for d, _ in gone),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def cases():
    plain = " ".join(f"w{i}" for i in range(60))
    texts = [None, "", plain, plain, plain, " ".join(["a b"] * 30), "LOUD " * 60, plain + " #1", "x y\x0bz & \t", "é" * 90, "Word " * 20000]
    sources = ["s", None, "t", "", "s"]
    docs = [(i, texts[i * 7 % len(texts)], sources[i % len(sources)]) for i in range(70)]
    docs += [(None, plain, "s"), (None, None, None), (3, plain, "t"), (3, plain, "t"), (3, "other", "t")]
    labels = [(i, i % 3 % 2, i % 2) for i in range(0, 60, 2)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1), (5, None, None), (999, 1, 1)]
    return docs, labels


def test_equals_applying_the_filters(spark):
    docs, labels = cases()
    frame = spark.createDataFrame(docs, DOCS).withColumns({"part": F.lit("q"), "digest": F.lit(1), "A": F.lit("x"), "fails": F.lit(0)})
    marks = spark.createDataFrame(labels, LABELS).withColumns({"part": F.lit(1), "good": F.lit("z")})
    got = A.filter_audit(frame, marks).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got} == plain_audit(docs, labels)
    assert len(got) == 4 * 600 - 600  # '' and null are one part


def test_one_text_held_by_most_documents(spark):
    docs = [(i, "same text" if i % 3 else f"own {i}", "hot") for i in range(900)]
    got = A.filter_audit(spark.createDataFrame(docs, DOCS), spark.createDataFrame([], LABELS))
    first = got.filter("filter_order = 'EABCD' AND step = 1").first()
    assert (first.kept, first.removed, first.good_lost) == (301, 599, 0)


def test_empty_tables(spark):
    none, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert A.filter_audit(none, labels).collect() == []
    one = A.filter_audit(spark.createDataFrame([(1, "x", None)], DOCS), labels).collect()
    assert len(one) == 600 and {r.part for r in one} == {""}
    assert {r.removed for r in one if r.filter_order[r.step - 1] != "A"} == {0}
