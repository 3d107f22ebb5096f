"""Bigram language model in a log-frequency Bloom filter, probed segment by segment.

Tokens are a text's words, A-Z lower-cased, and one end.  Texts are cut into
tokens once: each task writes blocks of some megabytes of text, which hold the
hashes of their distinct words and every token as a place among these.  All
later steps read these blocks.

Training counts every unigram and bigram of the training texts, quantises the
counts and holds them in a Bloom filter that is cut into segments by the
leading bits of an n-gram's hash.  A segment is sized by its own insertions and
the number of segments follows the bytes of text, so the filter grows with the
input and no n-gram is left out.  The filter isn't broadcast: each block sends
its distinct n-grams, with their training counts, to their segments.  There the
counts are summed, the segment is built and written, and each distinct n-gram
that any block sent is probed level after level; the levels go back to the
blocks.  A token's probability interpolates the bigram and unigram estimates,
all counts as the probes read them; the weight of the bigram is the share of
training bigrams that were seen more than once (Good-Turing).

The exact unigram counts of the base score take the same way: they are summed
in the segments, by the whole 64-bit hash of a word, and never are in one
place.  In a segment's filter an n-gram is known by 32 bits after its leading
ones; what that confuses only ever raises a count, as other false positives do.

Defined results: a null or empty text is one end token; a row without an id is
scored but not learned from, and counts as not held out; repeated rows are each
counted and scored; with no training text every count is 0; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import pfor
from tarmac.llm import tokens as T
from tarmac.llm.count_filter import MIDDLE, STARTS, CountFilter, level_of, split_key
from tarmac.llm.tables import fold_of, release_memory, table, written

BITS_PER_INSERTION = 12
#: Bytes of text of a block of documents (or one longer text; a row counts as
#: ROW_BYTES more; the last Arrow batch isn't cut for these), and of those one segment's n-grams come from.
BLOCK_BYTES = 8 << 20
ROW_BYTES = 32
SEGMENT_BYTES = 4 << 20
#: Rows are megabytes long: Parquet is to look at its buffers after each of them.
_LONG_ROWS = {"parquet.page.size.row.check.min": "1", "parquet.block.size.row.check.min": "1"}

_START, _END = (np.uint64(x) for x in (0x8E5A1C7F53544152, 0x3B60D2F9454E4430))

_BLOCKS = (
    "block long, size long, doc_id array<bigint>, held_out array<boolean>, learn array<boolean>,"
    " n array<bigint>, words binary, tokens binary"
)


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _cut(block_bytes: int, row_bytes: int):
    """Blocks of rows (doc_id, text, held_out, learn); block numbers are unique in what one run writes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        number = TaskContext.get().partitionId() << 32
        hashes: list[np.ndarray] = []
        rows: list[pa.RecordBatch] = []
        lengths: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            word, token = np.unique(np.concatenate(hashes), return_inverse=True)
            docs = pa.Table.from_batches(rows).combine_chunks()
            lists = {c: _one_list(docs.column(c).combine_chunks()) for c in ("doc_id", "held_out", "learn")}
            out = pa.record_batch(
                {
                    "block": pa.array([number], pa.int64()),
                    "size": pa.array([size], pa.int64()),
                    **lists,
                    "n": _one_list(pa.array(np.concatenate(lengths), pa.int64())),
                    "words": pa.array([word.tobytes()], pa.binary()),
                    "tokens": pa.array([token.astype(np.uint32).tobytes()], pa.binary()),
                }
            )
            for held in (hashes, rows, lengths):
                held.clear()
            return out

        for batch in batches:
            docs = batch.select(["doc_id", "held_out", "learn"])
            for lo, hi, w in T.words_by_slice(batch.column("text"), max_bytes=min(block_bytes, 1 << 20)):
                hashes.append(np.insert(w.hash, w.first[1:], _END))
                rows.append(docs.slice(lo, hi - lo))
                lengths.append(w.counts + 1)
                size += len(w.data) + row_bytes * (hi - lo)
                if size >= block_bytes:
                    yield flush()
                    number, size = number + 1, 0
        if hashes:
            yield flush()

    return run


@dataclass
class _Block:
    """One row of the blocks' table."""

    words: np.ndarray  # distinct words' hashes, ascending
    tokens: np.ndarray  # each token's place among them
    n: np.ndarray  # tokens of each text
    first: np.ndarray  # each text's first token

    def bigrams(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct bigrams and the start, ascending; the place there of the start and of each token with the one before."""
        h = self.words[self.tokens]
        before = np.concatenate([[_START], h[:-1]])
        before[self.first] = _START
        return np.unique(np.concatenate([[_START], T.combine(before, h)]), return_inverse=True)


def _read(rows: pa.Table | pa.RecordBatch, i: int) -> _Block:
    n = rows.column("n")[i].values.to_numpy()
    words, tokens = (
        np.frombuffer(rows.column(c)[i].as_py(), t) for c, t in (("words", np.uint64), ("tokens", np.uint32))
    )
    return _Block(words, tokens, n, np.cumsum(n) - n)


def _sorted_to_bytes(keys: np.ndarray) -> bytes:
    """Ascending 32-bit keys as the packed differences of neighbours."""
    return pfor.encode(np.diff(keys, prepend=np.uint64(0)).astype(np.uint32))


def _bytes_to_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(pfor.Segment(raw).all().astype(np.uint64), dtype=np.uint64)


_COUNTED = "segment int, block long, words binary, word_n binary, pairs binary, pair_n binary"


def _count_ngrams(segment_bits: int):
    """(segment, block, words, counts, keys of bigrams, counts): a block's distinct n-grams by segment."""

    def counted(rows: pa.RecordBatch, i: int) -> pa.RecordBatch:
        block = _read(rows, i)
        learn = rows.column("learn")[i].values.to_numpy(zero_copy_only=False).astype(bool)
        learned = np.repeat(learn, block.n)
        pair, place = block.bigrams()
        word_n = np.bincount(block.tokens[learned], minlength=len(block.words))
        pair_n = np.bincount(place[1:][learned], minlength=len(pair))
        pair_n[place[0]] += learn.sum()
        of_word, _ = split_key(block.words, segment_bits)
        of_pair, key = split_key(pair, segment_bits)
        segment = np.union1d(of_word, of_pair)
        w = np.append(np.searchsorted(of_word, segment), len(of_word)).tolist()
        p = np.append(np.searchsorted(of_pair, segment), len(of_pair)).tolist()
        packed = lambda x, cut, f: pa.array([f(x[a:b]) for a, b in zip(cut, cut[1:])], pa.binary())
        return pa.record_batch(
            {
                "segment": pa.array(segment, pa.int32()),
                "block": pa.array([rows.column("block")[i].as_py()] * len(segment), pa.int64()),
                "words": packed(block.words, w, np.ndarray.tobytes),
                "word_n": packed(word_n, w, pfor.encode),
                "pairs": packed(key, p, _sorted_to_bytes),
                "pair_n": packed(pair_n, p, pfor.encode),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        for batch in batches:
            for i in range(batch.num_rows):
                yield counted(batch, i)

    return run


def _plan_filter(sizes: np.ndarray) -> CountFilter:
    """The filter of a segment with so many keys at each level: a key is inserted at its level and all below."""
    insertions = int((sizes * np.arange(len(sizes))).sum())
    bits = max((max(insertions, 1) * BITS_PER_INSERTION - 1).bit_length(), 10)  # a very small one would fill unevenly
    load = (1 << bits) / max(insertions, 1)
    return CountFilter(0, bits, int(np.clip(round(load * np.log(2)), 1, 8)))


def _summed(keys: list[np.ndarray], counts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct keys of all blocks, their total counts, and each block's keys' places among them."""
    key, place = np.unique(np.concatenate(keys), return_inverse=True)
    n = np.concatenate([pfor.Segment(x).all() for x in counts])
    total = np.bincount(place, n, minlength=len(key)).astype(np.int64)
    return key, total, np.split(place, np.cumsum([len(k) for k in keys])[:-1])


_SEGMENTS = (
    "segment int, block long, word_n binary, word_level binary, pair_level binary,"
    " bits int, hashes int, data binary, sizes array<bigint>, tokens long, words long, single long"
)


def _segment(segment_bits: int):
    """A segment's filter (a row without a block), and a row for each block with what it asked for:
    the exact counts of its words, and the levels that probes of the filter read."""

    def run(counted: pa.Table) -> pa.Table:
        release_memory()
        columns = {c: counted.column(c).to_pylist() for c in ("words", "word_n", "pairs", "pair_n")}
        word, exact, word_places = _summed([np.frombuffer(x, np.uint64) for x in columns["words"]], columns["word_n"])
        pair, together, pair_places = _summed([_bytes_to_sorted(x) for x in columns["pairs"]], columns["pair_n"])
        key = np.concatenate([split_key(word, segment_bits)[1], pair])
        level = level_of(np.concatenate([exact, together]))
        sizes = np.bincount(level, minlength=len(STARTS) + 1)
        held = _plan_filter(sizes)
        data = held.segment(key, level)
        held.data = np.frombuffer(data, np.uint8)
        read = held.levels(key).astype(np.uint32)
        of_word, of_pair = read[: len(word)], read[len(word) :]
        segment = counted.column("segment")[0].as_py()
        answers = pa.table(
            {
                "segment": counted.column("segment"),
                "block": counted.column("block"),
                "word_n": pa.array([exact[x].tobytes() for x in word_places], pa.binary()),
                "word_level": pa.array([pfor.encode(of_word[x]) for x in word_places], pa.binary()),
                "pair_level": pa.array([pfor.encode(of_pair[x]) for x in pair_places], pa.binary()),
            }
        )
        built = pa.table(
            {
                "segment": pa.array([segment], pa.int32()),
                "bits": pa.array([held.bits], pa.int32()),
                "hashes": pa.array([held.hashes], pa.int32()),
                "data": pa.array([data], pa.binary()),
                "sizes": pa.array([sizes], pa.list_(pa.int64())),
                "tokens": pa.array([exact.sum()], pa.int64()),
                "words": pa.array([np.count_nonzero(exact)], pa.int64()),
                "single": pa.array([np.count_nonzero(exact == 1)], pa.int64()),
            }
        )
        both = pa.concat_tables([built, answers], promote_options="default")
        return both.select([x.split()[0] for x in _SEGMENTS.split(", ")])

    return run


@dataclass
class LanguageModel:
    """What all blocks need of the model besides the counts of their own n-grams."""

    tokens: int
    distinct: int
    bigram_weight: float

    def unigram(self, count: np.ndarray) -> np.ndarray:
        return (count + 0.5) / (self.tokens + 0.5 * (self.distinct + 1))

    def log_probability(self, alone: np.ndarray, context: np.ndarray, together: np.ndarray) -> np.ndarray:
        """log10 probability of each token, by its unigram probability and the counts of
        the token before it and of both."""
        weight = np.where(context > 0, self.bigram_weight, 0.0)
        return np.log10(weight * np.minimum(together, context) / np.maximum(context, 1) + (1 - weight) * alone)


def blocks_of(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, held_out, learn) as tokens, in written blocks."""
    cut = docs.select("doc_id", "text", "held_out", "learn").mapInArrow(_cut(BLOCK_BYTES, ROW_BYTES), _BLOCKS)
    return written(cut, "lm-blocks", _LONG_ROWS)


def train(blocks: DataFrame) -> tuple[LanguageModel, DataFrame]:
    """The model of the blocks' rows to learn from, and the written segments of its filter
    with their answers to every block."""
    size = blocks.agg(F.sum("size")).first()[0] or 0
    segment_bits = max(4, int(size // SEGMENT_BYTES).bit_length())
    counted = blocks.select("block", "learn", "n", "words", "tokens").mapInArrow(_count_ngrams(segment_bits), _COUNTED)
    segments = written(counted.groupBy("segment").applyInArrow(_segment(segment_bits), _SEGMENTS), "lm-segments", _LONG_ROWS)
    tokens, words, single, once = (
        x or 0
        for x in segments.filter("block IS NULL")
        .agg(F.sum("tokens"), F.sum("words"), F.sum("single"), F.sum(F.col("sizes")[1]))
        .first()
    )
    weight = 1 - max(once - single, 0) / tokens if tokens else 0.0  # once - single: bigrams that occur once
    return LanguageModel(int(tokens), int(words), weight), segments


_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(model: LanguageModel):
    """Scores of a block's documents, given its answers from all segments."""

    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        release_memory()
        block = _read(rows, 0)
        # In the order of the block's n-grams: segments are leading bits, and keys ascend in each.
        answers = answers.sort_by("segment")
        exact = np.concatenate([np.frombuffer(x, np.int64) for x in answers.column("word_n").to_pylist()])
        word, pair = (
            MIDDLE[np.concatenate([pfor.Segment(x).all() for x in answers.column(c).to_pylist()])]
            for c in ("word_level", "pair_level")
        )
        place = block.bigrams()[1]
        context = np.concatenate([[0.0], word[block.tokens[:-1]]])
        context[block.first] = pair[place[0]]
        score = model.log_probability(model.unigram(word)[block.tokens], context, pair[place[1:]])
        del context, place
        base = np.log10(model.unigram(exact))[block.tokens]
        known = (exact > 0)[block.tokens].astype(np.int64)
        return pa.table(
            {
                "doc_id": rows.column("doc_id")[0].values,
                "held_out": rows.column("held_out")[0].values,
                "n_tokens": pa.array(block.n, pa.int64()),
                "n_known": pa.array(np.add.reduceat(known, block.first), pa.int64()),
                "train_tokens": pa.array(np.full(len(block.n), model.tokens), pa.int64()),
                "base_score": pa.array(np.add.reduceat(base, block.first)),
                "score": pa.array(np.add.reduceat(score, block.first)),
            }
        )

    return run


def language_model_scores(docs: DataFrame) -> DataFrame:
    """Scores of every row of ``docs`` (doc_id, text) by a model of those outside fold 1."""
    fold = fold_of(F.col("doc_id"))
    blocks = blocks_of(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            "text",
            F.coalesce(fold == 1, F.lit(False)).alias("held_out"),
            F.coalesce(fold != 1, F.lit(False)).alias("learn"),
        )
    )
    model, segments = train(blocks)
    answers = segments.filter("block IS NOT NULL").select("block", "segment", "word_n", "word_level", "pair_level")
    rows = blocks.select("block", "doc_id", "held_out", "n", "words", "tokens")
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_score(model), _SCORED)


def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model_scores(table(spark, sf_dir, "documents"))
