"""Byte-level BPE against the library's encoding of whole texts."""

import hashlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarmac.llm import byte_bpe as B
from tarmac.llm.tables import ship

from ..conftest import SF_ORACLE, SF_SMALL

SCHEMA = "doc_id long, text string"


def digests(text):
    ids = B.vocabulary(B.default_ranks()).texts.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


@pytest.mark.parametrize("sf_dir", [SF_SMALL, SF_ORACLE])
def test_query_equals_whole_texts(spark, sf_dir):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall()
    got = B.op12_byte_bpe(spark, sf_dir).collect()
    assert sorted(map(tuple, got)) == sorted((i, *digests(t)) for i, t in rows)


def test_blocks_are_shuffled_once(spark):
    plan = B.op12_byte_bpe(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(block") <= 3
    frame = B.op12_byte_bpe(spark, SF_SMALL)
    frame.collect()
    final = frame._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in final


CASES = [
    (1, None),
    (2, ""),
    (3, " "),
    (4, "It's we'll  two   spaces \n\n\t x"),
    (5, "noé 你好 123456 \U0001f600!!! <|endoftext|>"),
    (6, "ab" * 300_000),
    (7, " " * 50_000 + "z" + "\n" * 50_000),
    (8, "\U0001c000 a\U00016ea7a 1\U00010ee7 ͸\x00\x1c"),
    (9, "word " * 200_000),
    (4, "same id"),
    (4, "same id"),
    (None, "no id"),
    (None, None),
]


def test_edge_cases(spark, monkeypatch):
    ship(spark)
    frame = spark.createDataFrame(CASES, SCHEMA).withColumns({"block": F.lit("x"), "words": F.lit(1), "ids": F.lit(2)})
    got = B.decode_documents(B.encode_documents(frame)).collect()
    want = [(i, digests(t)) for i, t in CASES]
    found = [
        (r.doc_id, (r.n_tokens, hashlib.sha256(bytes(r.ids)).hexdigest(), hashlib.sha256(bytes(r.decoded)).hexdigest())) for r in got
    ]
    assert sorted(found, key=str) == sorted(want, key=str)
    assert B.encode_documents(spark.createDataFrame([], SCHEMA)).collect() == []


def test_words_of_many_blocks_are_put_back(spark):
    texts = [(i, " ".join(f"w{i * j % 97} the" for j in range(i % 40))) for i in range(400)]
    frame = spark.createDataFrame(texts, SCHEMA).repartition(13)
    got = {r.doc_id: bytes(r.ids) for r in B.encode_documents(frame).collect()}
    encode = B.vocabulary(B.default_ranks()).texts.encode_ordinary
    assert got == {i: np.array(encode(t), "<u4").tobytes() for i, t in texts}


def test_unknown_ids_and_nulls_decode_to_null(spark):
    raw = [(1, 1, np.array([99_999_999], "<u4").tobytes()), (2, 0, b""), (3, None, None)]
    frame = spark.createDataFrame([(i, n, bytearray(x) if x is not None else None) for i, n, x in raw], "doc_id long, n_tokens long, ids binary")
    got = {r.doc_id: r.decoded for r in B.decode_documents(frame).collect()}
    assert got[1] is None and bytes(got[2]) == b"" and got[3] is None


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("ab12 \n\t'sé你 \x1c\U00016ea7\U0001c000")), max_size=60))
def test_pieces_are_split_as_the_library_splits(text):
    v = B.vocabulary(B.default_ranks())
    assert "".join(w for part in v.pieces(text) for w in part) == text
    assert [i for part in v.pieces(text) for w in part for i in v.encode(w)] == v.texts.encode_ordinary(text)


def test_packing_round_trips():
    for values in ([], [0], [1, 2**32 - 1, 5]):
        assert B._unpacked_numbers(B._packed_numbers(np.array(values, np.uint32))).tolist() == values
    for words in ([], [b""], [b"a", b"", "é".encode(), b"\x00"]):
        assert B._unpacked_words(B._packed_words(words), len(words)) == words
