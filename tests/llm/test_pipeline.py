"""Each pipeline stage on its own input against brute force."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from tarmac.llm import tables
from tarmac.llm.mixing import mixture
from tarmac.llm.quality_classifier import quality_scores
from tarmac.llm.tables import table, written

from ..conftest import SF_SMALL
from . import test_decontamination, test_near_duplicates, test_token_output


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def ids_of(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages(spark):
    assert [name for name, _ in C.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "token_output"]
    docs = table(spark, SF_SMALL, "documents")
    columns, all_rows = docs.columns, {r.doc_id: tuple(r) for r in docs.collect()}
    made = [docs]
    for name, stage in C.STAGES:
        made.append(written(stage(spark, made[-1], SF_SMALL), f"test-{name}"))
    for df in made[1:5]:
        assert df.columns == columns
        assert all(all_rows[r.doc_id] == tuple(r) for r in df.collect())  # kept documents are unchanged
    good = [r.doc_id for r in quality_scores(docs, table(spark, SF_SMALL, "labels")).filter("predicted = 1").collect()]
    assert ids_of(made[1]) == sorted(good) and 0 < len(good) < len(all_rows)

    texts = [(r.doc_id, r.text) for r in made[1].collect()]
    one_each = [r[0] for r in test_near_duplicates.brute_force(texts, 5) if r[3]]
    assert ids_of(made[2]) == sorted(one_each) and len(one_each) < len(texts)

    texts = [(r.doc_id, r.text) for r in made[2].collect()]
    items = [(r.item_id, r.text) for r in table(spark, SF_SMALL, "benchmark").collect()]
    clean = [r[0] for r in test_decontamination.brute_force(texts, items) if not r[5]]
    assert ids_of(made[3]) == sorted(clean) and len(clean) < len(texts)

    times = {r.doc_id: r.times for r in mixture(made[3]).collect()}
    assert ids_of(made[4]) == sorted(d for d, n in times.items() for _ in range(n))

    texts = sorted((r.doc_id, r.text) for r in made[4].collect())
    assert sorted(map(tuple, made[5].collect())) == sorted(test_token_output.brute_force(texts))
    assert rows_of(C.run(spark, SF_SMALL)) == rows_of(made[5])


@pytest.mark.parametrize("empty", [False, True])
def test_odd_tables(spark, empty, monkeypatch):
    columns = "doc_id long, text string, lang string, source string, n_chars long, score double, component string"
    long = " ".join(f"word{i}" for i in range(20_000))
    rows = [
        (None, None, None, None, None, None, None),
        (1, "", "en", "a", 0, 1.0, "x"),
        (2, long, "en", "a", len(long), None, None),
        (2, long, "en", "a", len(long), None, None),
        (3, "plain words in a row", None, None, 5, 0.5, ""),
    ]
    docs = spark.createDataFrame([] if empty else rows, columns)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([(None, None), (1, "plain words in a row")], "item_id long, text string")
    small = {"labels": labels, "benchmark": benchmark}
    monkeypatch.setattr(C, "table", lambda s, d, name: small[name])
    for name, stage in C.STAGES:
        before, docs = docs, written(stage(spark, docs, SF_SMALL), f"test-odd-{name}")
        if name != "token_output":
            assert docs.columns == before.columns
        if name == "decontamination":
            assert docs.filter(F.col("doc_id") == 3).count() == 0
    assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert (docs.count() == 0) == empty


def test_workers_hold_nothing_between_tasks(monkeypatch):
    given, stage = [], SimpleNamespace(stageId=lambda: 10**9)
    monkeypatch.setattr(tables, "_trim", lambda: given.append(1))
    monkeypatch.setattr(tables, "_released_for", -1)
    monkeypatch.setattr(tables, "TaskContext", SimpleNamespace(get=lambda: stage))
    mine, other = {"a": 1}, {"b": 2}
    monkeypatch.setattr(tables, "caches", [mine, other])
    assert list(tables.giving_back(lambda batches: (2 * x for x in batches), keep=mine)(iter([1, 2]))) == [2, 4]
    assert mine and not other and len(given) == 2  # at the stage's first task's start, at the task's end

    def broken(batches):
        yield next(batches)
        raise ValueError

    with pytest.raises(ValueError):
        list(tables.giving_back(broken)(iter([1])))
    assert mine and len(given) == 3  # same stage: only the task's end


def test_all_python_of_the_stages_gives_memory_back(spark, monkeypatch):
    functions, frame = [], type(spark.range(0))
    as_is = frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", lambda self, f, *a, **b: functions.append(f) or as_is(self, f, *a, **b))
    docs = spark.createDataFrame([(i, f"words of text {i} and more") for i in range(3)], "doc_id long, text string")
    docs = docs.withColumns({"source": F.lit("a"), "lang": F.lit("en")})
    for name, stage in C.STAGES:
        docs = written(stage(spark, docs, SF_SMALL), f"test-given-{name}")
    assert len(functions) >= 10
    assert all(f.__code__.co_filename.endswith("tables.py") and hasattr(f, "__wrapped__") for f in functions)
