"""Token-ID files: documents encoded, in id order, as patched frame-of-reference blocks.

``write_token_files`` encodes every text with a public tokenizer, appends an
end id, and writes shards in ascending id order.  A shard is a Parquet file
whose rows are segments: the ids of whole documents (about ``SEGMENT_IDS``, or
one longer document) coded by ``pfor``, with the documents' ids and lengths and
the number of ids that precede the segment in its shard.  Spark's own writer
commits the files, so a lost executor leaves no partial shard.
``read_token_files`` and ``token_digests`` read them back.

Words between ASCII white space are encoded independently of each other by the
tokenizer, so each worker keeps the ids of words it has met (a bounded cache)
and calls the library for new words only.  A text that might hold a special
token is encoded whole.

Defined results: a null or empty text is one end id; ids ascend, null ids come
first; rows that share an id are all written, next to each other; empty tables
write no rows; extra columns are ignored.
"""

from __future__ import annotations

import os
import sys
import zlib
from array import array
from collections.abc import Iterator
from string import ascii_lowercase

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.llm import pfor
from tarmac.llm import tokens as T
from tarmac.llm.tables import caches, giving_back, shared_path, table

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
SEGMENT_IDS = 1 << 16
#: Words whose ids a worker keeps; beyond that it goes on with those of the texts at hand.
CACHED_WORDS = 250_000
#: Bytes of text that a worker encodes at once; words and new ids of it are Python objects.
ENCODED_AT_ONCE = 1 << 18

#: Signs that make tokens of their own where they follow a letter or digit at a word's end.
_TAIL = b"#*$%&|!,.;:?"
_encoders: dict[str, WordEncoder] = {}
caches.append(_encoders)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def _packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder != "little":
        out.byteswap()
    return out.tobytes()


class WordEncoder:
    """Encodes texts word by word; ids come as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words: dict[bytes, bytes] = {}
        # How the pre-tokenizer writes each Latin letter (it maps bytes to signs; a to z stay as they are).
        letters = [chr(c) for c in range(256) if chr(c).isalpha() and chr(c) == chr(c).lower()]
        self.letters = {ord(c): self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in letters}
        self.plain = all(self.letters[ord(c)] == c for c in ascii_lowercase)

    def _encode_words(self, words: list[bytes]) -> list[bytes]:
        """As ``_encode``; a word of Latin letters only is one pre-token, which the model takes as it is."""
        out, rest = {}, []
        for word in words:
            text = word.decode()
            if not text.isalpha():
                rest.append(word)
            elif self.plain and text.isascii() and text.islower():
                out[word] = _packed([x.id for x in self.model.tokenize(text)])
            elif max(text) <= "\xff":
                out[word] = _packed([x.id for x in self.model.tokenize(text.lower().translate(self.letters))])
            else:
                rest.append(word)
        out.update(zip(rest, self._encode(rest), strict=True))
        return [out[word] for word in words]

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([x.decode() for x in texts], add_special_tokens=False)
        return [_packed(x.ids) for x in found]

    def _learn(self, new: set[bytes]) -> None:
        """Add the ids of new words; a word that ends in signs is its body and those signs."""
        ends_in_signs = [word for word in new if word[-1] in _TAIL]
        parts = {}
        for word in ends_in_signs:
            body = word.rstrip(_TAIL)
            last = body[-1:].decode() if body[-1:].isascii() else body.decode()[-1:]
            if last.isalnum() and len(last.lower()) == 1:
                parts[word] = (body, word[len(body) :])
        needed = new.difference(parts).union(*parts.values()).difference(self.words)
        needed = list(needed)
        self.words.update(zip(needed, self._encode_words(needed), strict=True))
        for word, (body, tail) in parts.items():
            self.words[word] = self.words[body] + self.words[tail]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        split = [None if b"<|" in x else x.lower().split() for x in texts]
        met = set().union(*filter(None, split))
        new = met.difference(self.words)
        if len(self.words) + len(new) > CACHED_WORDS:
            self.words = {x: self.words[x] for x in met.difference(new)}
        if new:
            self._learn(new)
        ids = self.words.__getitem__
        return [self._encode([x])[0] if one is None else b"".join(map(ids, one)) for x, one in zip(texts, split, strict=True)]


def _encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


_FILE = "shard int, segment int, before long, n_ids long, doc_id array<long>, n_tokens array<long>, ids binary"


def _to_segments(path: str, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, segment, before = TaskContext.get().partitionId(), 0, 0
        docs: list[int | None] = []
        ids: list[bytes] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal segment, before, docs, ids, held
            values = np.frombuffer(b"".join(ids), "<u4")
            row = {
                "shard": pa.array([shard], pa.int32()),
                "segment": pa.array([segment], pa.int32()),
                "before": pa.array([before], pa.int64()),
                "n_ids": pa.array([len(values)], pa.int64()),
                "doc_id": pa.array([docs], pa.list_(pa.int64())),
                "n_tokens": pa.array([[len(x) // 4 for x in ids]], pa.list_(pa.int64())),
                "ids": pa.array([pfor.encode(values)], pa.binary()),
            }
            segment, before, docs, ids, held = segment + 1, before + len(values), [], [], 0
            return pa.record_batch(row)

        encoder = _encoder(path)
        for batch in batches:
            data, start = T.text_bytes(batch.column("text"))
            names = batch.column("doc_id")
            for lo, hi in T.slices(start, ENCODED_AT_ONCE):
                raw = [data[a:b].tobytes() for a, b in zip(start[lo:hi], start[lo + 1 : hi + 1], strict=True)]
                for name, found in zip(names[lo:hi].to_pylist(), encoder.encode(raw), strict=True):
                    docs.append(name)
                    ids.append(found + end)
                    held += len(ids[-1]) // 4
                    if held >= SEGMENT_IDS:
                        yield flush()
        if ids:
            yield flush()

    return giving_back(run, keep=_encoders)


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> None:
    """Write the ids of ``docs`` (doc_id, text) under ``path`` in ascending doc_id order.

    Rows are dealt by ranges of (doc_id, hash of text), so one id that very
    many rows share is split as well.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("tie", F.xxhash64("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select("doc_id", "text")
    rows.mapInArrow(_to_segments(tokenizer or default_tokenizer(), end_id), _FILE).write.parquet(path)


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows with ``start``, the number of ids in all earlier segments.

    The shards' totals are one short row a shard, of which there are as many as
    the writer had partitions.
    """
    rows = spark.read.schema(_FILE).parquet(path)
    totals = rows.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(bases), "shard").withColumn("start", F.col("base") + F.col("before"))


def _documents(batch: pa.RecordBatch) -> Iterator[tuple[int | None, int, np.ndarray]]:
    columns = (batch.column(c).to_pylist() for c in ("doc_id", "n_tokens", "start", "ids"))
    for names, lengths, start, raw in zip(*columns, strict=True):
        ids = pfor.Segment(raw).all()
        at = 0
        for name, n in zip(names, lengths, strict=True):
            yield name, start + at, ids[at : at + n]
            at += n


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start and ids (array) of every document in the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = list(_documents(batch.slice(i, 1)))
                yield pa.record_batch(
                    {
                        "doc_id": pa.array([x[0] for x in found], pa.int64()),
                        "start": pa.array([x[1] for x in found], pa.int64()),
                        "ids": pa.array([x[2].astype(np.int64) for x in found], pa.list_(pa.int64())),
                    }
                )

    return _segments(spark, path).mapInArrow(giving_back(run, keep=_encoders), "doc_id long, start long, ids array<long>")


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(name, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for name, start, ids in _documents(batch)]
            names = ("doc_id", "start", "n_tokens", "ids_crc32")
            yield pa.record_batch({c: pa.array([x[i] for x in found], pa.int64()) for i, c in enumerate(names)})

    return _segments(spark, path).mapInArrow(
        giving_back(run, keep=_encoders), "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def tokenised(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write the documents' token files in the shared folder; the digests read back from them."""
    spark = docs.sparkSession
    path = shared_path(spark, "tokens")
    write_token_files(docs, path, tokenizer)
    return token_digests(spark, path)


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenised(table(spark, sf_dir, "documents"))
