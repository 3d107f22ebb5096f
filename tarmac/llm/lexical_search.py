"""Ranked lexical search: an index of geometric blocks with maximum summaries.

1. ``postings`` cuts every whole text into terms once: a document's length and
   the terms of it that the items ask for, with their occurrences.  The number
   of documents, all terms, and documents a term are summed from them.
2. ``build_index`` deals documents into shards.  Within a shard, a term's posting
   list is clustered by document similarity (random projections of the
   documents' weighted terms; the list's own evenly spaced members are the
   centroids) and cut into blocks.  A block stores the coordinatewise maximum
   of its documents' impacts, rounded up to 8 bits, and the shard the documents
   themselves.  The index is a written table, one row a shard.
3. ``search_index`` walks an item's posting lists from the shortest on.  A block
   is skipped only if the item's weights times its summary stay below the tenth
   score found so far; documents of shorter lists are done with, so a summary
   needs the coordinates of its own and longer lists only, and the walk ends when
   no later list can reach the tenth score.  All other documents are scored exactly.
4. The shards' ten best are ranked together.

Items are worked on in blocks of ``ITEM_BYTES`` of text, each against all
documents; only such a block's vocabulary is broadcast or brought to the driver.
A document with more than ``LONG_TERMS`` of the vocabulary's terms is scored for
every item instead of being entered in each of its posting lists.  No list,
block or candidate is cut off.

Defined results: a null text has no terms and is not counted; an item without
terms, or none of whose terms occur, has no rows; documents are rows, so rows
that share an id are ranked one by one, and rows of items that share an id too;
equal scores rank by ascending id, null ids last; a null item id stays null;
without documents or items there are no rows; extra columns are ignored.  Terms
are identified by a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.llm import pfor
from tarmac.llm import tokens as T
from tarmac.llm.tables import table, written

TOP = 10
ITEM_BYTES = 1 << 20
SHARD_DOCS, SHARD_POSTINGS = 4096, 1 << 19
LIST_BLOCK = 64
LONG_TERMS = 4096
DIMENSIONS = 8
#: Impacts stay below 1e6; a summary counts them in units of UNIT, rounded up.
UNIT = 4096
#: Values in a block of the index's patched frame-of-reference arrays.
STORED_BLOCK = 1 << 13
#: Bytes of terms: ASCII letters and digits and all of every other character.
TERMS = T.ALPHANUMERIC


@dataclass
class Items:
    """One block of items: the sorted hashes of their terms, and each item's distinct terms (as places in it)."""

    number: np.ndarray
    vocabulary: np.ndarray
    terms: list[np.ndarray]


def _items(rows: pa.Table) -> Items:
    data, start = T.text_bytes(rows.column("text"))
    w = T.words(data, start, TERMS, lower=True)
    vocabulary, place = np.unique(w.hash, return_inverse=True)
    terms = [np.unique(place[a:b]) for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
    return Items(rows.column("item").to_numpy(), vocabulary, terms)


def _item_blocks(items: DataFrame, block_bytes: int) -> Iterator[Items]:
    """Items (item, text) in blocks of about ``block_bytes`` of text, one at a time."""
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-int(total) // block_bytes))
    for k in range(n):
        yield _items(items.filter(F.pmod(F.xxhash64("item"), F.lit(n)) == k).select("item", "text").toArrow())


def postings(docs: DataFrame, vocabulary: Broadcast) -> DataFrame:
    """doc_id, n (terms with repeats), terms and tf (of the vocabulary's terms) of documents that have a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            for lo, hi, w in T.words_by_slice(batch.column("text"), TERMS, lower=True):
                place = np.searchsorted(known, w.hash)
                place[place == len(known)] = 0
                hit = known[place] == w.hash
                pairs, tf = np.unique(w.text_of[hit] * len(known) + place[hit], return_counts=True)
                first = np.searchsorted(pairs, np.arange(hi - lo + 1) * len(known)).astype(np.int32)
                row = {
                    "doc_id": batch.column("doc_id")[lo:hi],
                    "n": pa.array(w.counts, pa.int64()),
                    "terms": pa.ListArray.from_arrays(first, pa.array((pairs % len(known)).astype(np.int32))),
                    "tf": pa.ListArray.from_arrays(first, pa.array(tf.astype(np.int32))),
                }
                yield pa.record_batch(row).filter(pa.array(w.counts > 0))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, tf array<int>")


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, df) of each batch."""
    for batch in batches:
        term, df = np.unique(batch.column("terms").flatten().to_numpy(), return_counts=True)
        yield pa.record_batch({"term": pa.array(term, pa.int32()), "df": pa.array(df, pa.int64())})


def term_weights(found: DataFrame, size: int) -> tuple[np.ndarray, int, int]:
    """The weight of each term of the vocabulary, the number of documents and of all their terms."""
    n, length = (int(x or 0) for x in found.agg(F.count("*"), F.sum("n")).first())
    counts = found.select("terms").mapInArrow(_document_counts, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(size, np.int64)
    df[counts.column("term").to_numpy()] = counts.column("df").to_numpy()
    return np.floor(1000 * np.log((2 * n + 2) / (2 * df + 1))).astype(np.int64), n, length


class _Rows:
    """Ragged rows: ``of(which)`` gives the elements of some rows and where each row begins."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths
        self.start = np.cumsum(lengths) - lengths

    def of(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = self.lengths[which]
        begin = np.cumsum(n) - n
        return np.repeat(self.start[which] - begin, n) + np.arange(n.sum()), begin


def _similarity_order(position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by cluster of a posting list's documents (their positions), and each one's block."""
    n = len(position)
    if n <= LIST_BLOCK:
        return np.arange(n), np.zeros(n, np.int64)
    k = -(-n // LIST_BLOCK)
    centroids = position[np.arange(k) * n // k]
    cluster = np.concatenate([(position[lo : lo + 2048] @ centroids.T).argmax(axis=1) for lo in range(0, n, 2048)])
    order = np.argsort(cluster, kind="stable")
    cluster = cluster[order]
    begins = np.searchsorted(cluster, cluster)
    part = (np.arange(n) - begins) // (2 * LIST_BLOCK)
    new = np.concatenate([[False], (cluster[1:] != cluster[:-1]) | (part[1:] != part[:-1])])
    return order, np.cumsum(new)


def _maximum(key: np.ndarray, values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, ascending, and each one's largest value (values above 0)."""
    if len(key) * 8 < size:
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        return key[first], np.maximum.reduceat(values[order], first)
    dense = np.zeros(size, np.uint8)
    np.maximum.at(dense, key, values)
    found = np.flatnonzero(dense)
    return found, dense[found]


@dataclass
class Shard:
    """Documents (rows of terms and impacts) and the blocks of their posting lists.

    Terms are numbered within the shard by the length of their lists, shortest
    first; ``place`` is each one's place in the vocabulary.  Block b belongs to
    the list of ``block_term[b]`` (ascending); its documents are row b of
    ``block_docs``, its summary row b of (``sum_term``, ``sum_max``).  It has
    the coordinates of this and longer lists only: a search is done with the
    documents of shorter ones by then.  ``long_docs`` are in no list.
    """

    doc_id: np.ndarray
    no_id: np.ndarray
    place: np.ndarray
    n_terms: np.ndarray
    term: np.ndarray
    impact: np.ndarray
    block_term: np.ndarray
    block_size: np.ndarray
    block_docs: np.ndarray
    sum_size: np.ndarray
    sum_term: np.ndarray
    sum_max: np.ndarray
    long_docs: np.ndarray


def build_shard(n: np.ndarray, n_terms: np.ndarray, term: np.ndarray, tf: np.ndarray, weight: np.ndarray, docs: int, length: int) -> dict[str, np.ndarray]:
    """The arrays of the shard of documents that have at least one term of the vocabulary each."""
    start = np.cumsum(n_terms) - n_terms
    m = 10 + (90 * n * docs) // length
    tf = tf.astype(np.int64)
    impact = (1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, n_terms))
    axes = np.random.default_rng(7).choice(np.array([-1, 1], np.float32), (len(weight), DIMENSIONS))
    strength = (weight[term] * (impact / 1e6)).astype(np.float32)
    position = np.add.reduceat(axes[term] * strength[:, None], start)
    position /= np.maximum(np.linalg.norm(position, axis=1, keepdims=True), 1e-9)
    is_long = n_terms > LONG_TERMS
    owner = np.repeat(np.arange(len(n)), n_terms)
    place, local = np.unique(term, return_inverse=True)
    sizes = np.bincount(local[~is_long[owner]], minlength=len(place))
    by_size = np.argsort(sizes, kind="stable")
    rank = np.empty(len(place), np.int64)
    rank[by_size] = np.arange(len(place))
    order = np.lexsort((rank[local], owner))  # each document's terms, rarest first
    term, impact = rank[local][order], impact[order]
    bound = np.maximum(-(-impact // UNIT), 1).astype(np.uint8)
    row_end = np.repeat(start + n_terms, n_terms)
    listed = np.flatnonzero(~is_long[owner])
    listed = listed[np.argsort(term[listed], kind="stable")]
    names, first = np.unique(term[listed], return_index=True)
    block_term, block_size, block_docs, sum_size, sum_term, sum_max = [], [], [], [], [], []
    for name, at in zip(names.tolist(), np.split(listed, first[1:]) if len(names) else [], strict=True):
        by_likeness, block = _similarity_order(position[owner[at]])
        at = at[by_likeness]
        blocks, width = int(block[-1]) + 1, len(place) - name
        rest = row_end[at] - at  # this and the document's more common terms
        each = np.repeat(at - (np.cumsum(rest) - rest), rest) + np.arange(rest.sum())
        key, top = _maximum(np.repeat(block, rest) * width + term[each] - name, bound[each], blocks * width)
        block_term.append(np.full(blocks, name, np.int32))
        block_size.append(np.bincount(block))
        block_docs.append(owner[at].astype(np.int32))
        sum_size.append(np.bincount(key // width, minlength=blocks))
        sum_term.append((key % width + name).astype(np.int32))
        sum_max.append(top)

    def joined(parts: list[np.ndarray], kind: type = np.int32) -> np.ndarray:
        return np.concatenate([np.zeros(0, kind), *parts]).astype(kind)

    lists = [joined(x) for x in (block_term, block_size, block_docs, sum_size, sum_term)]
    arrays = (place[by_size], n_terms, term, impact, *lists, joined(sum_max, np.uint8), np.flatnonzero(is_long))
    return dict(zip(_ARRAYS, arrays, strict=True))


_ARRAYS = ("place", "n_terms", "term", "impact", "block_term", "block_size", "block_docs", "sum_size", "sum_term", "sum_max", "long_docs")
_INDEX = "shard long, doc_id array<long>, " + ", ".join(f"{c} binary" for c in _ARRAYS)


def build_index(found: DataFrame, weight: Broadcast, docs: int, length: int) -> DataFrame:
    """One row a shard of ``found`` (``postings``): its documents, blocks and summaries.

    Documents are dealt evenly over tasks; a shard has at most ``SHARD_DOCS``
    documents and about ``SHARD_POSTINGS`` postings.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        n_docs = n_postings = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, n_docs, n_postings, number
            t = pa.Table.from_batches(held).combine_chunks()
            terms, tf = (t.column(c).combine_chunks() for c in ("terms", "tf"))
            n_terms = terms.value_lengths().to_numpy().astype(np.int64)
            arrays = build_shard(t.column("n").to_numpy(), n_terms, terms.flatten().to_numpy(), tf.flatten().to_numpy(), weight.value, docs, length)
            row = {"shard": pa.array([number], pa.int64()), "doc_id": pa.array([t.column("doc_id").to_pylist()], pa.list_(pa.int64()))}
            row |= {c: pa.array([pfor.encode(x, block=STORED_BLOCK)], pa.binary()) for c, x in arrays.items()}
            held, n_docs, n_postings, number = [], 0, 0, number + 1
            return pa.record_batch(row)

        for batch in batches:
            sizes = np.cumsum(batch.column("terms").value_lengths().to_numpy())
            lo = 0
            while lo < batch.num_rows:
                base = int(sizes[lo - 1]) if lo else 0
                room = max(SHARD_POSTINGS - n_postings, 1)
                hi = min(batch.num_rows, lo + SHARD_DOCS - n_docs, max(lo + 1, int(np.searchsorted(sizes, base + room))))
                held.append(batch.slice(lo, hi - lo))
                n_docs, n_postings, lo = n_docs + hi - lo, n_postings + int(sizes[hi - 1]) - base, hi
                if n_docs >= SHARD_DOCS or n_postings >= SHARD_POSTINGS:
                    yield flush()
        if held:
            yield flush()

    some = found.filter(F.size("terms") > 0)
    n = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return some.repartition(n).mapInArrow(run, _INDEX)


class Searcher:
    """Finds an item's best documents in one shard; ``skipped`` and ``visited`` count blocks."""

    def __init__(self, shard: Shard, weight: np.ndarray):
        self.shard, self.weight = shard, weight[shard.place]
        self.docs, self.blocks, self.summaries = _Rows(shard.n_terms), _Rows(shard.block_size), _Rows(shard.sum_size)
        self.own_max = shard.sum_max[self.summaries.start]  # of each block, for its list's term
        self.number = np.full(len(weight), -1)
        self.number[shard.place] = np.arange(len(shard.place))
        self.wanted = np.zeros(len(shard.place), np.int64)  # weights of the item's terms
        self.skipped = self.visited = 0

    def scores(self, docs: np.ndarray) -> np.ndarray:
        at, begin = self.docs.of(docs)
        return np.add.reduceat(self.wanted[self.shard.term[at]] * self.shard.impact[at], begin)

    def bounds(self, lo: int, hi: int) -> np.ndarray:
        """Of blocks lo to hi - 1: at least the score of any of their documents that no shorter list holds."""
        begin = self.summaries.start[lo:hi]
        end = int(begin[-1] + self.summaries.lengths[hi - 1])
        parts = self.wanted[self.shard.sum_term[begin[0] : end]] * self.shard.sum_max[begin[0] : end]
        return UNIT * np.add.reduceat(parts, begin - begin[0])

    def _better(self, best: tuple[np.ndarray, np.ndarray], docs: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``top`` of ``best`` (documents, scores) and ``docs``, best first."""
        if not len(docs):
            return best
        found = self.scores(docs)
        docs, found = np.concatenate([best[0], docs[found > 0]]), np.concatenate([best[1], found[found > 0]])
        order = np.lexsort((self.shard.doc_id[docs], self.shard.no_id[docs], -found))[:top]
        return docs[order], found[order]

    def best(self, terms: np.ndarray, top: int = TOP) -> tuple[np.ndarray, np.ndarray]:
        """(document, score) of the ``top`` documents, best first; scores above 0 only."""
        s = self.shard
        terms = np.sort(self.number[terms])
        terms = terms[terms >= 0]
        first, last = np.searchsorted(s.block_term, terms), np.searchsorted(s.block_term, terms, "right")
        lists = [(a, b) for a, b in zip(first.tolist(), last.tolist(), strict=True) if a < b]
        self.wanted[terms] = self.weight[terms]
        reach = [UNIT * int(self.weight[s.block_term[a]] * self.own_max[a:b].max()) for a, b in lists]
        seen = np.zeros(len(s.doc_id), bool)
        best = self._better((np.zeros(0, np.int64), np.zeros(0, np.int64)), s.long_docs, top)
        for i, (a, b) in enumerate(lists):
            least = int(best[1][-1]) if len(best[1]) >= top else 1
            if sum(reach[i:]) < least:  # nor does any document of the later lists reach it
                self.skipped += sum(y - x for x, y in lists[i:])
                break
            bound = self.bounds(a, b)
            order = np.argsort(-bound, kind="stable")
            done, step = 0, 1
            while done < len(order):
                least = int(best[1][-1]) if len(best[1]) >= top else 1
                some = order[done : done + step]
                some = some[bound[some] >= least]
                if not len(some):
                    break
                at, _ = self.blocks.of(a + some)
                docs = s.block_docs[at]
                docs = docs[~seen[docs]]
                seen[docs] = True
                best = self._better(best, docs, top)
                done, step = done + len(some), 2 * step
            self.visited += done
            self.skipped += len(order) - done
        self.wanted[terms] = 0
        return best


def read_shard(row: dict) -> Shard:
    ids = row["doc_id"]
    arrays = {c: pfor.Segment(row[c]).all() for c in _ARRAYS}
    arrays |= {c: arrays[c].astype(np.int64) for c in ("n_terms", "impact", "block_size", "sum_size")}
    arrays["sum_max"] = arrays["sum_max"].astype(np.uint8)
    return Shard(np.array([x or 0 for x in ids], np.int64), np.array([x is None for x in ids], bool), **arrays)


def search_index(index: DataFrame, items: Broadcast, weight: Broadcast, top: int = TOP) -> DataFrame:
    """(item, doc_id, score): each shard's ``top`` documents of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                searcher = Searcher(read_shard(row), weight.value)
                number, ids, scores = [], [], []
                for item, terms in zip(items.value.number.tolist(), items.value.terms, strict=True):
                    docs, found = searcher.best(terms, top)
                    number += [item] * len(docs)
                    ids += [row["doc_id"][i] for i in docs.tolist()]
                    scores += found.tolist()
                yield pa.record_batch({"item": pa.array(number, pa.int64()), "doc_id": pa.array(ids, pa.int64()), "score": pa.array(scores, pa.int64())})

    return index.mapInArrow(run, "item long, doc_id long, score long")


def lexical_search(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = ITEM_BYTES) -> DataFrame:
    """item_id, rank, doc_id and score of the ``top`` documents of ``docs`` (doc_id, text) for each row of ``items`` (item_id, text)."""
    spark = docs.sparkSession
    items = written(items.select("item_id", "text").withColumn("item", F.monotonically_increasing_id()), "search-items")
    hits = [spark.createDataFrame([], "item long, doc_id long, score long")]
    for block in _item_blocks(items, block_bytes):
        if not len(block.vocabulary):
            continue
        found = written(postings(docs, spark.sparkContext.broadcast(block.vocabulary)), "search-postings")
        values, n, length = term_weights(found, len(block.vocabulary))
        if n:
            weight = spark.sparkContext.broadcast(values)
            index = written(build_index(found, weight, n, length), "search-index")
            hits.append(search_index(index, spark.sparkContext.broadcast(block), weight, top))
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = reduce(DataFrame.unionByName, hits).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.join(items.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH documents_terms AS (
  SELECT row_number() OVER () AS d, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), counted AS (
  SELECT d, doc_id, terms, len(terms) AS n FROM documents_terms WHERE len(terms) > 0
), totals AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM counted
), occurrences AS (
  SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(terms) AS term FROM counted) AS t GROUP BY d, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM occurrences, totals GROUP BY term, docs
), items AS (
  SELECT row_number() OVER () AS item, item_id,
    list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS terms
  FROM benchmark
), lengths AS (
  SELECT d, doc_id, 10 + (90 * n * docs) // length AS m FROM counted, totals
), scored AS (
  SELECT item, d, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM (SELECT item, unnest(terms) AS term FROM items) AS q JOIN weights USING (term) JOIN occurrences USING (term) JOIN lengths USING (d)
  GROUP BY item, d
), ranked AS (
  SELECT item, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
  FROM scored JOIN lengths USING (d) WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked JOIN items USING (item) WHERE rank <= 10
"""
