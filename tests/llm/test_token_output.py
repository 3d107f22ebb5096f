"""Token files: exact round trip, and the query against encoding each text whole."""

import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarmac.llm import pfor, tables
from tarmac.llm import token_output as O
from tarmac.llm.tables import shared_path, table

from ..conftest import SF_SMALL


def brute_force(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(O.default_tokenizer())
    out, start = [], 0
    for doc, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 50), max_size=300), st.integers(1, 64), st.floats(0, 1))
def test_pfor_round_trip(values, block, percentile):
    values = np.array(values, np.uint32)
    segment = pfor.Segment(pfor.encode(values, block, percentile))
    assert segment.all().tolist() == values.tolist()
    for i in range(len(segment.start)):
        assert segment.block(i).tolist() == values[i * block : (i + 1) * block].tolist()


def test_pfor_packs_at_the_percentile_and_patches_the_rest():
    values = np.array([100 + i % 8 for i in range(1000)] + [2**31] * 24, np.uint32)
    segment = pfor.Segment(pfor.encode(values))
    assert segment.width.tolist() == [3] and segment.wrong.tolist() == [24]
    assert len(segment.payload) == 1024 * 3 // 8 + 24 * 6
    with pytest.raises(ValueError):
        pfor.Segment(b"nope" + bytes(20))


TEXTS = [
    "The THE the's it's we'll don't ###the### the### the's### x'd",
    "éÉ é### É ΣΑΣ ΑΣ. İstanbul İ. ß ﬁ x́### Å.",
    "tab\tnew\nline\x0b\x0c\r\x1c\x1dand\x85nbsp\xa0em x.",
    "a <|endoftext|> b<|startoftext|>c <| d <|ENDOFTEXT|>",
    "1234 12.5% $5.00 +1 (499) 555-6503 a1b2.# ½. ²! ١٢٣؟",
    "ª º µ ÀÉÎõÿ×÷ ßẞ Ðð Ÿ ſ naïve Ünïcode ÅNGSTRÖM dž",
    "日本語のテキスト。ひらがな! 한국어. ไทย. 👍🏽### 👩‍👩‍👧!!",
    "",
    None,
    " \n ",
]


def test_words_encode_as_whole_texts():
    encoder = O.WordEncoder(O.default_tokenizer())
    got = encoder.encode([(x or "").encode() for x in TEXTS])
    whole = encoder._encode([(x or "").encode() for x in TEXTS])
    assert got == whole
    assert encoder.encode([(x or "").encode() for x in TEXTS]) == whole  # from the cache


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aB'sé́Σς #*.!<|1½ \t ͅİtТ", max_size=30))
def test_any_text_encodes_as_whole(text):
    encoder = O._encoder(O.default_tokenizer())
    assert encoder.encode([text.encode()]) == encoder._encode([text.encode()])


def test_a_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(O, "CACHED_WORDS", 5)
    encoder = O.WordEncoder(O.default_tokenizer())
    for texts in (["a b c"], ["d e f g"], ["a b c d e f g h i j# k#"], ["a z"]):
        raw = [x.encode() for x in texts]
        assert encoder.encode(raw) == encoder._encode(raw)


def test_a_full_cache_keeps_the_words_at_hand(monkeypatch):
    monkeypatch.setattr(O, "CACHED_WORDS", 5)
    encoder = O.WordEncoder(O.default_tokenizer())
    encoder.encode([b"a b c d"])
    learned, learn = [], encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda new: learned.append(set(new)) or learn(new))
    assert encoder.encode([b"c d", b"e f c"]) == encoder._encode([b"c d", b"e f c"])
    assert learned == [{b"e", b"f"}] and set(encoder.words) == {b"c", b"d", b"e", b"f"}


def test_a_worker_encodes_little_text_at_once(monkeypatch):
    class Recorder:
        sizes: list[int] = []

        def encode(self, texts):
            self.sizes.append(sum(map(len, texts)))
            return [bytes(4) for _ in texts]

    task = SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0, stageId=lambda: -2))
    monkeypatch.setattr(O, "TaskContext", task)
    monkeypatch.setattr(tables, "TaskContext", task)
    monkeypatch.setattr(tables, "caches", [])
    monkeypatch.setattr(O, "_encoder", lambda path: Recorder())
    texts = ["x" * 1000] * 3000 + ["y" * 2_000_000]
    batch = pa.record_batch({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts)})
    rows = list(O._to_segments("", O.END_ID)(iter([batch])))
    assert sum(len(x["doc_id"][0]) for x in rows) == len(texts) and sum(Recorder.sizes) == sum(map(len, texts))
    assert sorted(Recorder.sizes)[-2] <= O.ENCODED_AT_ONCE <= 1 << 18  # one longer text is encoded alone
    assert Recorder.sizes[-1] == 2_000_000


def test_arrow_batches_are_small(spark):
    tables.ship(spark)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 2 << 20


def test_query_equals_whole_texts(spark):
    docs = sorted(tuple(r) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect())
    got = sorted(tuple(r) for r in O.op3_token_output(spark, SF_SMALL).collect())
    assert got == brute_force(docs)


def test_edge_cases(spark):
    docs = [(i * 7 % 9, x) for i, x in enumerate(TEXTS)] + [(20, "same"), (20, "same"), (None, "nobody"), (-5, "first " * 300)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"shard": F.lit(1), "start": F.lit("x"), "ids": F.lit(2)})
    got = [tuple(r) for r in O.tokenised(frame).orderBy("start").collect()]
    expected = brute_force(sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0)))
    assert got == expected
    path = shared_path(spark, "test")
    O.write_token_files(frame, path)
    ids = {(r.doc_id, r.start): r.ids for r in O.read_token_files(spark, path).collect()}
    for doc, start, n, crc in expected:
        assert len(ids[doc, start]) == n and zlib.crc32(np.array(ids[doc, start], "<u4").tobytes()) == crc


def test_empty_table(spark):
    assert O.tokenised(spark.createDataFrame([], "doc_id long, text string")).collect() == []
