"""Byte-level BPE: each distinct word of the corpus is encoded once.

1. ``_cut`` splits every text into pre-tokens and gives each a position: runs of
   documents (``BLOCK_BYTES`` of text, or one longer text) become blocks, in
   which a pre-token is a number into the block's own list of distinct words.
   Positions so stay packed, one row a block; the words are dealt to buckets by
   a hash of their bytes.
2. The words of all blocks are shuffled by bucket.  A task meets the rows of a
   bucket one after the other, encodes a word when it first sees it, and
   answers every block with the ids of its words, in the block's order.
3. The answers are joined back by block, and each document's ids are put
   together by position.

A word is in one row a block however often it occurs, so a word that a third of
all text consists of weighs as much as any other.  A bucket holds the distinct
words of 1 in ``BUCKETS_PER_PARTITION * spark.sql.shuffle.partitions`` hashes.

``decode_documents`` joins each id with the token-byte table (one entry an id of
the vocabulary file, which bounds it) and concatenates the bytes.

Pre-tokens are split with the ``regex`` library.  Code points that its Unicode
version counts as letters or digits and the encoder's older one does not are
found when a worker starts (``_disputed``) and split as the encoder does.

Defined results: a null or empty text has no ids; a document's ids do not depend
on other documents; every row gets a row, ids repeated or null too; a binary
that holds an id outside the vocabulary decodes to null; empty tables give no
rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import sys
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import islice, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.tables import table

RANKS = "byte_bpe_multi_50k.tiktoken"
BLOCK_BYTES = 16 << 20
BUCKETS_PER_PARTITION = 8
#: Pre-tokens of one text, or of one block, that are worked on at a time.
AT_ONCE = 1 << 18
#: A character that is neither letter, digit nor space in any version of Unicode.
_OTHER = "☃"


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path(RANKS)


def read_ranks(path: str) -> dict[bytes, int]:
    """The token-byte table of a vocabulary file: each token's bytes and its id."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Vocabulary:
    """One vocabulary file's splitter, encoder of single words, and token bytes."""

    def __init__(self, path: str):
        import tiktoken
        from public_tokenizers import PATTERN

        ranks = read_ranks(path)
        self.token_bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.token_bytes[rank] = token
        self.pattern = regex.compile(PATTERN)
        self.texts = tiktoken.Encoding("texts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        # The whole string is one match: a word that was split off already.
        self.words = tiktoken.Encoding("words", pat_str="(?s:.+)", mergeable_ranks=ranks, special_tokens={})
        disputed = self._disputed()
        self.stand_in = dict.fromkeys(map(ord, disputed), _OTHER)
        self.has_disputed = regex.compile("[" + "".join(disputed) + "]") if disputed else None

    def _disputed(self) -> list[str]:
        """Letters and digits that only the splitter's Unicode version knows."""
        new = regex.compile(r"[\p{L}\p{N}]")
        unknown = (chr(c) for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Cn")
        return [c for c in unknown if new.match(c) and any(self._differs(s) for s in (f"a{c}a", f"1{c}1"))]

    def _differs(self, text: str) -> bool:
        return self.texts.encode_ordinary(text) != [i for w in self.pattern.findall(text) for i in self.encode(w)]

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The text's pre-tokens in order, at most about ``AT_ONCE`` at a time."""
        if self.has_disputed is not None and self.has_disputed.search(text):
            found = (text[m.start() : m.end()] for m in self.pattern.finditer(text.translate(self.stand_in)))
        elif len(text) <= AT_ONCE:
            yield self.pattern.findall(text)
            return
        else:
            found = (m.group() for m in self.pattern.finditer(text))
        while part := list(islice(found, AT_ONCE)):
            yield part

    def encode(self, word: str) -> list[int]:
        return self.words.encode_ordinary(word)

    def decode(self, ids: np.ndarray) -> bytes | None:
        if len(ids) and int(ids.max()) >= len(self.token_bytes):
            return None
        return b"".join(map(self.token_bytes.__getitem__, ids.tolist()))


_vocabularies: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


class _Numbers(dict):
    """Numbers words in the order of their first appearance."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


def _packed_numbers(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, compressed byte plane by byte plane."""
    planes = np.ascontiguousarray(values.astype("<u4")).view(np.uint8).reshape(-1, 4).T
    return zlib.compress(planes.tobytes(), 1)


def _unpacked_numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u4")


def _packed_words(words: list[bytes]) -> bytes:
    lengths = np.array([len(w) for w in words], "<u4")
    return zlib.compress(lengths.tobytes() + b"".join(words), 1)


def _unpacked_words(data: bytes, n: int) -> list[bytes]:
    raw = zlib.decompress(data)
    end = np.cumsum(np.frombuffer(raw, "<u4", n), dtype=np.int64) + 4 * n
    return [raw[a:b] for a, b in pairwise([4 * n, *end.tolist()])]


_BLOCKS = (
    "block long, doc_id array<long>, n_pieces array<long>, numbers binary, word_order binary, "
    "bucket array<int>, n_words array<int>, words array<binary>"
)


def _block_row(block: int, docs: list, n_pieces: list[int], numbers: list[np.ndarray], words: _Numbers, buckets: int) -> pa.RecordBatch:
    """A block's documents and positions, and its words by bucket (``word_order``: their numbers)."""
    spelled = [w.encode() for w in words]
    bucket = np.array([zlib.crc32(w) % buckets for w in spelled], np.int64)
    order = np.argsort(bucket, kind="stable")
    names, first = np.unique(bucket[order], return_index=True)
    runs = np.split(order, first[1:]) if len(order) else []
    row = {
        "block": pa.array([block], pa.int64()),
        "doc_id": pa.array([docs], pa.list_(pa.int64())),
        "n_pieces": pa.array([n_pieces], pa.list_(pa.int64())),
        "numbers": pa.array([_packed_numbers(np.concatenate([np.zeros(0, np.uint32), *numbers]))], pa.binary()),
        "word_order": pa.array([_packed_numbers(order)], pa.binary()),
        "bucket": pa.array([names], pa.list_(pa.int32())),
        "n_words": pa.array([[len(r) for r in runs]], pa.list_(pa.int32())),
        "words": pa.array([[_packed_words([spelled[i] for i in r.tolist()]) for r in runs]], pa.list_(pa.binary())),
    }
    return pa.record_batch(row)


def _cut(path: str, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        block = TaskContext.get().partitionId() << 32
        docs, n_pieces, numbers, words, held = [], [], [], _Numbers(), 0
        for batch in batches:
            for name, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py() or ""
                docs.append(name)
                n_pieces.append(0)
                for part in v.pieces(text):
                    numbers.append(np.fromiter(map(words.__getitem__, part), np.uint32, len(part)))
                    n_pieces[-1] += len(part)
                held += len(text)
                if held >= BLOCK_BYTES:
                    yield _block_row(block, docs, n_pieces, numbers, words, buckets)
                    block += 1
                    docs, n_pieces, numbers, words, held = [], [], [], _Numbers(), 0
        if docs:
            yield _block_row(block, docs, n_pieces, numbers, words, buckets)

    return run


def _words_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, block, n_words, words) of each block."""
    for batch in batches:
        lists = {c: batch.column(c) for c in ("bucket", "n_words", "words")}
        n = lists["bucket"].value_lengths().to_numpy(zero_copy_only=False)
        yield pa.record_batch({"block": pa.array(np.repeat(batch.column("block").to_numpy(), n)), **{k: v.flatten() for k, v in lists.items()}})


def _encode_words(path: str):
    """(block, bucket, counts, ids) of rows sorted by bucket; a bucket's distinct words are encoded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        known: dict[bytes, list[int]] = {}
        here = None
        for batch in batches:
            counts, ids = [], []
            columns = (batch.column(c).to_pylist() for c in ("bucket", "n_words", "words"))
            for bucket, n, words in zip(*columns, strict=True):
                if bucket != here:
                    here, known = bucket, {}
                found = []
                for word in _unpacked_words(words, n):
                    one = known.get(word)
                    if one is None:
                        one = known[word] = v.encode(word.decode())
                    found.append(one)
                counts.append(_packed_numbers(np.array([len(x) for x in found])))
                ids.append(_packed_numbers(np.array([i for x in found for i in x])))
            if counts:
                yield pa.record_batch(
                    {"block": batch.column("block"), "bucket": batch.column("bucket"), "counts": pa.array(counts, pa.binary()), "ids": pa.array(ids, pa.binary())}
                )

    return run


def _reassemble(block: pa.Table, answers: pa.Table) -> pa.Table:
    """Each document's ids, from its block's positions and the ids of the block's words."""
    if not block.num_rows:
        raise ValueError("words of a block that is not there")
    names, n_pieces, numbers, order = (block.column(c)[0].as_py() for c in ("doc_id", "n_pieces", "numbers", "word_order"))
    numbers, order = _unpacked_numbers(numbers), _unpacked_numbers(order)
    answers = answers.sort_by("bucket")
    none = [np.zeros(0, np.uint32)]
    counts = np.concatenate([_unpacked_numbers(x) for x in answers.column("counts").to_pylist()] or none).astype(np.int64)
    flat = np.concatenate([_unpacked_numbers(x) for x in answers.column("ids").to_pylist()] or none)
    if len(counts) != len(order):
        raise ValueError(f"{len(order)} words in the block, {len(counts)} encoded")
    count, start = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    count[order], start[order] = counts, np.cumsum(counts) - counts
    ids, n_tokens = [], np.zeros(len(names), np.int64)
    end = np.cumsum(n_pieces)
    lo = 0
    for i in range(len(names)):
        parts = []
        for a in range(lo, int(end[i]), AT_ONCE):
            which = numbers[a : min(a + AT_ONCE, int(end[i]))]
            n = count[which]
            total = int(n.sum())
            at = np.repeat(start[which] - (np.cumsum(n) - n), n) + np.arange(total)
            parts.append(flat[at].astype("<u4").tobytes())
            n_tokens[i] += total
        ids.append(b"".join(parts))
        lo = int(end[i])
    return pa.table({"doc_id": pa.array(names, pa.int64()), "n_tokens": pa.array(n_tokens), "ids": pa.array(ids, pa.binary())})


def encode_documents(docs: DataFrame, ranks: str | None = None) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit) of every row of ``docs`` (doc_id, text).

    The shuffled blocks are read twice (the exchange is reused): their words go
    to the buckets, and the ids come back to them.
    """
    ranks = ranks or default_ranks()
    buckets = BUCKETS_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    blocks = rows.mapInArrow(_cut(ranks, buckets), _BLOCKS).repartition("block")
    # An Arrow function, not a projection, which would make the exchange below another one.
    words = blocks.mapInArrow(_words_of_blocks, "block long, bucket int, n_words int, words binary")
    words = words.repartition("bucket").sortWithinPartitions("bucket")
    answers = words.mapInArrow(_encode_words(ranks), "block long, bucket int, counts binary, ids binary")
    return (
        blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_reassemble, "doc_id long, n_tokens long, ids binary")
    )


def decode_documents(encoded: DataFrame, ranks: str | None = None) -> DataFrame:
    """``encoded`` (doc_id, n_tokens, ids) with ``decoded``, the bytes of the ids."""
    ranks = ranks or default_ranks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(ranks)
        for batch in batches:
            decoded = (v.decode(np.frombuffer(x.as_buffer(), "<u4")) if x.is_valid else None for x in batch.column("ids"))
            yield batch.append_column("decoded", pa.array(decoded, pa.binary()))

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded binary")


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decode_documents(encode_documents(table(spark, sf_dir, "documents")))
    return found.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
