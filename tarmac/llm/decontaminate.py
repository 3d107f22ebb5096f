"""Benchmark decontamination with an FM-index per shard of training documents.

Words are runs of ASCII letters, digits and non-ASCII characters, A-Z
lower-cased.  A phrase is every ``window`` consecutive words of a benchmark
item, or the whole item if it is shorter.  Each task cuts its documents into
shards of whole documents (a longer document into overlapping pieces), builds
an FM-index over each shard's words, searches all phrases backward, locates
their occurrences by sampled suffix positions and merges them into spans.
Words that no phrase holds share one symbol, which no phrase contains.

The phrases are broadcast in blocks of about ``block_bytes`` of item text: the
items' symbols once, and where each distinct phrase begins.  A larger benchmark
makes further blocks, each one more pass over the documents.  What a pass finds
is written with the documents before the next one, so that no task holds more
than one block; phrases of a block are told apart by 64-bit hashes.

Defined results: a null or empty text has no words, no spans and is clean; a
null or wordless item has no phrase; items that share an id count once; an item
without an id hits words but isn't listed; repeated documents are judged alike;
empty tables give clean documents or no rows; extra columns are ignored or, by
``drop_contaminated``, kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tarmac.llm import tokens as T
from tarmac.llm.fm_index import FMIndex
from tarmac.llm.tables import giving_back, table, written

WINDOW = 13
#: A document is contaminated if at least one word in this many is hit.
HIT_ONE_IN = 20
BLOCK_BYTES = 16 << 20
SHARD_BYTES = 2 << 20
SHARD_WORDS = 1 << 20
_OTHER = 1  # symbol of words outside all phrases; 0 ends a shard


class Phrases:
    """Phrases of a block of items: the items' symbols, where distinct phrases begin in them, and whose they are."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        text = pa.array([x[1] for x in items], pa.large_string())
        w = T.words(*T.text_bytes(text), T.ALPHANUMERIC)
        self.window = window
        self.vocabulary = np.unique(w.hash)
        self.symbols = len(self.vocabulary) + 2
        self.text = (np.searchsorted(self.vocabulary, w.hash) + 2).astype(np.int32)
        self.ids = sorted({x[0] for x in items if x[0] is not None})
        number = {x: i for i, x in enumerate(self.ids)}
        owner = np.array([number.get(x[0], -1) for x in items], np.int32)
        #: (length, starts in ``text``, offsets, items): phrase i is of items[offsets[i]:offsets[i + 1]]
        self.groups: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        item_of = w.text_of.astype(np.int32)
        for n in range(1, window + 1):
            phrase, at = T.ngrams(w, n)
            if n < window:  # an item of fewer words is one phrase
                short = (w.counts == n)[item_of[at]]
                phrase, at = phrase[short], at[short]
            if not len(at):
                continue
            _, first, which = np.unique(phrase, return_index=True, return_inverse=True)
            del phrase
            pairs = which * (len(self.ids) + 1) + owner[item_of[at]] + 1
            starts = at[first].astype(np.int32)
            del which, at, first
            pairs = np.unique(pairs)
            pairs = pairs[pairs % (len(self.ids) + 1) > 0]
            of_phrase, of_item = np.divmod(pairs, len(self.ids) + 1)
            cut = np.searchsorted(of_phrase, np.arange(len(starts) + 1)).astype(np.int32)
            self.groups.append((n, starts, cut, (of_item - 1).astype(np.int32)))

    def find(self, w: T.Words) -> tuple[np.ndarray, list[set[str]]]:
        """Which words any phrase covers, and each text's items."""
        covered = np.zeros(len(w.hash) + 1, np.int64)
        items: list[set[str]] = [set() for _ in w.counts]
        place = np.searchsorted(self.vocabulary, w.hash)
        place[place == len(self.vocabulary)] = 0
        symbol = np.where(self.vocabulary[place] == w.hash, place + 2, _OTHER) if len(self.vocabulary) else place
        of = w.text_of
        step = SHARD_WORDS if len(symbol) > SHARD_WORDS else max(len(symbol), 1)
        for lo in range(0, len(symbol) if self.groups else 0, step):
            self._find_piece(lo, symbol[lo : lo + step + self.window - 1], of[lo : lo + step + self.window - 1], covered, items)
        return np.cumsum(covered[:-1]) > 0, items

    def _find_piece(self, lo: int, symbol: np.ndarray, of: np.ndarray, covered: np.ndarray, items: list[set[str]]) -> None:
        # one separator word after each text, then the only 0; shift: separators before a word
        shift = of - of[0]
        text = np.full(len(symbol) + shift[-1] + 2, _OTHER, np.int64)
        text[np.arange(len(symbol)) + shift] = symbol
        text[-1] = 0
        index = FMIndex(text, self.symbols)
        word_at = np.zeros(len(text), np.int64)
        word_at[np.arange(len(symbol)) + shift] = np.arange(len(symbol))
        for length, starts, cut, owners in self.groups:
            found, first, end = index.search(self.text, starts, length)
            n = end - first
            rows = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            word = word_at[index.locate(rows)]
            np.add.at(covered, lo + word, 1)
            np.add.at(covered, lo + word + length, -1)
            pairs = np.unique(of[word] * len(starts) + np.repeat(found, n))
            for text_no, phrase in zip((pairs // len(starts)).tolist(), (pairs % len(starts)).tolist(), strict=True):
                items[text_no].update(self.ids[i] for i in owners[cut[phrase] : cut[phrase + 1]])


def _spans(hit: np.ndarray) -> list[int]:
    """Flat list start, end, start, end ... of the runs of hit words."""
    return np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8))).tolist()


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[str | None, str | None]]]:
    """Items (id, text) in blocks of about ``block_bytes``, one at a time."""
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-int(total) // block_bytes))
    for k in range(n):
        yield [tuple(r) for r in items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).collect()]


def find_spans(
    docs: DataFrame, items: DataFrame, text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES, prefix: str = ""
) -> DataFrame:
    """``docs`` with n_words, spans and items of each text appended.

    ``items`` has the columns id (string) and text.  ``spans`` is a flat list
    of word indexes (start, end, start, end ...) of the merged runs of hit
    words; ``items`` the ids, sorted, of items with an occurring phrase.
    ``prefix`` is put before the three names.
    """
    names = [prefix + x for x in ("n_words", "spans", "items")]
    found = [
        StructField(names[0], LongType()),
        StructField(names[1], ArrayType(LongType())),
        StructField(names[2], ArrayType(StringType())),
    ]
    base, at = docs.columns, docs.columns.index(text)
    schema = StructType([*docs.schema.fields, *found])
    sc, out = docs.sparkSession.sparkContext, docs
    for number, block in enumerate(_blocks(items, block_bytes)):
        if number:  # the pass before is done and its phrases are given back
            out = written(out, "decontamination")
            shared.unpersist()
        shared = sc.broadcast(Phrases(block, window))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            phrases = shared.value
            for batch in batches:
                data, start = T.text_bytes(batch.column(at))
                for lo, hi in T.slices(start, SHARD_BYTES):
                    w = T.words(data[start[lo] : start[hi]], start[lo : hi + 1] - start[lo], T.ALPHANUMERIC)
                    hit, own = phrases.find(w)
                    part = batch.slice(lo, hi - lo)
                    if part.num_columns > len(base):  # what earlier blocks found
                        for i, old in enumerate(part.column(len(base) + 1).to_pylist()):
                            for a, b in zip(old[::2], old[1::2], strict=True):
                                hit[w.first[i] + a : w.first[i] + b] = True
                        for mine, old in zip(own, part.column(len(base) + 2).to_pylist(), strict=True):
                            mine.update(old)
                    spans = [_spans(hit[a:b]) if hit[a:b].any() else [] for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
                    new = [
                        pa.array(w.counts, pa.int64()),
                        pa.array(spans, pa.list_(pa.int64())),
                        pa.array([sorted(x) for x in own], pa.list_(pa.string())),
                    ]
                    yield pa.RecordBatch.from_arrays([*part.columns[: len(base)], *new], names=[*base, *names])

        out = out.mapInArrow(giving_back(search), schema)
    return out


def _n_hit(spans: str) -> F.Column:
    """Words inside the spans: the ends less the starts."""
    return F.aggregate(F.transform(F.col(spans), lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0).cast("long"), lambda a, x: a + x)


def _contaminated(n_hit: F.Column, n_words: F.Column) -> F.Column:
    return (n_hit > 0) & (HIT_ONE_IN * n_hit >= n_words)


def items_of(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id").cast("string").alias("id"), "text")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: words, hit words, items, their digest, and the verdict."""
    found = find_spans(docs.select("doc_id", "text"), items_of(benchmark), window=window)
    listed = F.array_join(F.array_sort("items"), ",")
    return found.withColumn("n_hit", _n_hit("spans")).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"),
        _contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
        "spans",
    )


def _free_prefix(docs: DataFrame) -> str:
    prefix = "found_"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix = f"_{prefix}"
    return prefix


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that are not contaminated."""
    prefix = _free_prefix(docs)
    found = find_spans(docs, items_of(benchmark), window=window, prefix=prefix)
    return found.filter(~_contaminated(_n_hit(f"{prefix}spans"), F.col(f"{prefix}n_words"))).select(*docs.columns)


def cut_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the hit words (and what stands between them) cut out of ``text``."""
    prefix = _free_prefix(docs)
    found = find_spans(docs, items_of(benchmark), window=window, prefix=prefix)
    columns, at, spans_at = docs.columns, docs.columns.index("text"), len(docs.columns) + 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for i, spans in enumerate(batch.column(spans_at).to_pylist()):
                if spans:
                    w = T.words(*T.text_bytes(pa.array([texts[i]], pa.large_string())), T.ALPHANUMERIC)
                    raw, kept, last = w.data.tobytes(), [], 0
                    for a, b in zip(spans[::2], spans[1::2], strict=True):
                        kept.append(raw[last : w.start[a]])
                        last = w.end[b - 1]
                    texts[i] = b"".join([*kept, raw[last:]]).decode()
            out = list(batch.columns[: len(columns)])
            out[at] = pa.array(texts, out[at].type)
            yield pa.RecordBatch.from_arrays(out, names=columns)

    return found.mapInArrow(cut, docs.schema)


def items_digest(items: list[str]) -> str:
    """The digest that ``contamination`` returns for a list of item ids."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")
