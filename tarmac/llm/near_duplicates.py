"""Near-duplicate documents: MinHash, banding, verification, connected components.

1. A document's set holds the hashes of its distinct word shingles.  Documents
   with the same set (found by a 128-bit fingerprint of the set) form a class,
   represented by its smallest id; all later work is on representatives.
2. ``BANDS * ROWS`` universal hash functions (multiply-shift) give each set a
   signature of minima; each band of ``ROWS`` minima is a bucket.  Two sets of
   similarity 0.8 miss every shared bucket with a probability of 3e-6.
3. First pass: each member of a bucket is compared with the bucket's first
   member only, which is linear in the bucket.  Second pass, over buckets whose
   members are still in several components: pairs that share a rare shingle are
   found by it; for all others the count of common shingles bounds the
   intersection, and those that these bounds let be similar are compared by
   signature, block by block (a group of two blocks holds about ``2 * BLOCK``
   rows, so no task grows with the bucket).  A pair goes on if its signatures
   agree almost as the threshold asks (4.9 standard deviations of slack), and
   is a link only if the full sets confirm it.
4. Links become components by alternating large-star and small-star.

No pairs are emitted between members of one component, and none between copies.

Defined results: a null text, or one without words, has the empty set and is
linked with nothing; fewer words than a shingle make one shingle of the whole
sequence; rows that share an id are one node, which gets the links of all its
rows; a row without an id is linked with nothing (component null, kept); empty
tables give no rows; extra columns are ignored or, by ``keep_one_of_each``,
kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import tokens as T
from tarmac.llm.components import components
from tarmac.llm.tables import giving_back, table, written

BANDS, ROWS = 32, 5
#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Share of equal minima that sends a pair to the exact check (0.8 less 4.9 deviations).
SIGNATURE_SHARE = 0.645
BLOCK = 512
#: Most sets that hold a rare shingle.
RARE = 8
#: log2 of the bits of the id filter (8 MB) before full sets are cut.
ID_BITS = 26

_rng = np.random.default_rng(20240801)
_MULTIPLIER = _rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSET = _rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)


def shingle_sets(w: T.Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and each text's first index.

    Texts of 1 to k-1 words have one shingle, their whole sequence.
    """
    h, at = T.ngrams(w, k)
    of = w.text_of[at] if len(at) else at
    for n in range(1, k):
        short = np.flatnonzero(w.counts == n)
        if len(short):
            one = w.hash[w.first[short]] + np.uint64(n)
            for j in range(1, n):
                one = T.combine(one, w.hash[w.first[short] + j])
            h, of = np.concatenate([h, one]), np.concatenate([of, short])
    by = np.lexsort((h, of))
    h, of = h[by], of[by]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
    h, of = h[new], of[new]
    return h, np.searchsorted(of, np.arange(len(w.first)))


def _signatures(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A row of minima (upper 32 bits of multiply-shift) for each non-empty set."""
    start = first[:-1][np.diff(first) > 0]
    out = np.empty((len(start), BANDS * ROWS), np.uint32)
    for i in range(BANDS * ROWS):
        out[:, i] = np.minimum.reduceat(h * _MULTIPLIER[i] + _OFFSET[i], start) >> np.uint64(32)
    return out


def _sketch(k: int):
    """Rows (id, n_shingles, two fingerprints, signature); empty sets have a null signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, w in T.words_by_slice(batch.column("text"), max_bytes=1 << 19):
                h, first = shingle_sets(w, k)
                n = np.diff(first)
                has = n > 0
                prints = np.zeros((2, hi - lo), np.uint64)
                sig: list[bytes | None] = [None] * (hi - lo)
                if has.any():
                    prints[0, has] = np.add.reduceat(T.mix(h), first[:-1][has])
                    prints[1, has] = np.add.reduceat(T.mix(h ^ np.uint64(0x5851F42D4C957F2D)), first[:-1][has])
                    for i, row in zip(np.flatnonzero(has), _signatures(h, first), strict=True):
                        sig[i] = row.tobytes()
                yield pa.record_batch(
                    {
                        "id": batch.column("id")[lo:hi],
                        "n_shingles": pa.array(n, pa.int64()),
                        "print_a": pa.array(prints[0].view(np.int64), pa.int64()),
                        "print_b": pa.array(prints[1].view(np.int64), pa.int64()),
                        "signature": pa.array(sig, pa.binary()),
                    }
                )

    return giving_back(run)


def _places(ids: np.ndarray) -> np.ndarray:
    return T.mix(ids.view(np.uint64)) >> np.uint64(64 - ID_BITS)


def _id_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, bits): the ids' places in a bit array, by 64-bit word."""
    for batch in batches:
        place = _places(batch.column("id").to_numpy())
        bits = np.uint64(1) << (place & np.uint64(63))
        yield pa.record_batch({"word": pa.array((place >> np.uint64(6)).view(np.int64)), "bits": pa.array(bits.view(np.int64))})


def _id_bits(ids: DataFrame) -> Broadcast:
    """A bit array of ``2**ID_BITS`` bits in which the hashes of ``ids`` are set.

    Its size is fixed.  It only spares the texts of other documents the shuffle
    (of a few of them it doesn't); joins by id follow.
    """
    words = ids.mapInArrow(giving_back(_id_words), "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    data = np.zeros(1 << (ID_BITS - 6), np.uint64)
    data[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return ids.sparkSession.sparkContext.broadcast(data)


def _may_hold(data: np.ndarray, ids: pa.Array) -> pa.Array:
    place = _places(ids.fill_null(0).to_numpy(zero_copy_only=False))
    return pa.array((data[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool))


def _sets(k: int, wanted: Broadcast):
    """(id, shingles) of the rows whose id may be wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(_may_hold(wanted.value, batch.column("id")))
            for lo, hi, w in T.words_by_slice(batch.column("text"), max_bytes=1 << 19):
                h, first = shingle_sets(w, k)
                lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(h.view(np.int64), pa.int64()))
                yield pa.record_batch({"id": batch.column("id")[lo:hi], "shingles": lists})

    return giving_back(run)


def _full_sets(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """Written (id, shingles) of the documents with these ids (and a few others)."""
    found = docs.filter("id IS NOT NULL").mapInArrow(_sets(k, _id_bits(ids)), "id long, shingles array<long>")
    return written(found, "near-sets")


def _band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, band, id) for each band of each signature."""
    salt = np.arange(BANDS, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
    for batch in batches:
        rows = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).reshape(-1, BANDS, ROWS)
        h = np.broadcast_to(T.mix(salt), rows.shape[:2])
        for j in range(ROWS):
            h = T.combine(h, rows[:, :, j].astype(np.uint64))
        ids = np.repeat(batch.column("id").to_numpy(zero_copy_only=False), BANDS)
        band = np.tile(np.arange(BANDS, dtype=np.int32), len(rows))
        yield pa.record_batch({"bucket": pa.array(h.ravel().view(np.int64)), "band": pa.array(band), "id": pa.array(ids, pa.int64())})


def _shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, n, sig): the lowest byte of each minimum (the highest is 0 for most sets), a quarter of the signature."""
    for batch in batches:
        if batch.num_rows:
            whole = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).reshape(batch.num_rows, -1)
            short = (whole & np.uint32(255)).astype(np.uint8)
            yield pa.record_batch([batch.column("id"), batch.column("n_shingles"), pa.array([x.tobytes() for x in short], pa.binary())], ["id", "n", "sig"])


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose shortened signatures agree in SIGNATURE_SHARE of the minima (at least where the whole ones do)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("sig_a", "sig_b"))
        good = (a == b).mean(axis=1) >= SIGNATURE_SHARE
        yield batch.select(["a", "b"]).filter(pa.array(good))


def _between_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Similar pairs of different components in each group (bucket, i, j) of sorted rows.

    A group holds the rows of block i (side 0) and block j (side 1) of a
    bucket, or those of one block alone, so about ``2 * BLOCK`` rows at most.  A
    pair that shares several buckets is given by that of its first band only.
    """
    rest: pa.Table | None = None
    for batch in batches:
        here = pa.Table.from_batches([batch])
        whole = pa.concat_tables([rest, here]).combine_chunks() if rest is not None else here
        key = np.stack([whole.column(c).to_numpy() for c in ("bucket", "i", "j")])
        cut = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        cut = np.concatenate([[0], cut])
        yield from _pairs_of_groups(whole.slice(0, cut[-1]), cut)
        rest = whole.slice(cut[-1])
    if rest is not None:
        yield from _pairs_of_groups(rest, np.array([0, rest.num_rows]))


def _pairs_of_groups(rows: pa.Table, cut: np.ndarray) -> Iterator[pa.RecordBatch]:
    if not rows.num_rows:
        return
    ids, component, n, common, side, band = (
        rows.column(c).to_numpy() for c in ("id", "component", "n_shingles", "common", "side", "band")
    )
    sig = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint32).reshape(rows.num_rows, -1)
    found_a, found_b = [], []
    for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        middle = lo + int(np.searchsorted(side[lo:hi], 1))
        for x in range(lo, middle if middle < hi else hi):
            begin = middle if middle < hi else x + 1
            y = np.arange(begin, hi)
            most = np.minimum(common[y], common[x])  # of the intersection, without rare shingles
            y = y[(component[y] != component[x]) & (100 * most >= PERCENT * (n[y] + n[x] - most))]
            if len(y):
                same = sig[y] == sig[x]
                first_band = same.reshape(len(y), BANDS, ROWS).all(axis=2).argmax(axis=1)
                y = y[(same.mean(axis=1) >= SIGNATURE_SHARE) & (first_band == band[x])]
                found_a.append(np.minimum(ids[x], ids[y]))
                found_b.append(np.maximum(ids[x], ids[y]))
    if found_a:
        yield pa.record_batch({"a": pa.array(np.concatenate(found_a)), "b": pa.array(np.concatenate(found_b))})


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough.

    Both joins are on scans, so a document in very many pairs is split by the
    skew join.
    """
    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a")
    both = left.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    return both.filter(100 * common >= PERCENT * (F.size("x") + F.size("y") - common)).select("a", "b")


def _by_rarity(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(id, common)`` and the pairs ``(a, b)`` that share a rare shingle.

    A shingle is rare if at most ``RARE`` of the sets hold it; ``common`` counts
    an id's other shingles.  Two sets that share no rare shingle have at most
    the smaller ``common`` in their intersection; all others are in the pairs,
    of which a shingle gives at most ``RARE * (RARE - 1) / 2``.
    """
    each = sets.select("id", F.explode("shingles").alias("shingle"))
    rare = each.groupBy("shingle").agg(F.count("*").alias("n")).filter(F.col("n") <= RARE).select("shingle")
    found = each.join(written(rare, "near-rare"), "shingle")
    # Sets that share one rare shingle mostly share many: their lists of holders are the same.
    lists = found.groupBy("shingle").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    holders = written(lists.groupBy("ids").agg(F.count("*").alias("shingles")), "near-holders")
    own = holders.select(F.explode("ids").alias("id"), "shingles").groupBy("id").agg(F.sum("shingles").alias("rare"))
    sizes = sets.groupBy("id").agg(F.max(F.size("shingles")).cast("long").alias("size"), F.count("*").alias("rows"))
    sizes = sizes.join(own, "id", "left")
    # An id with several sets counts with the whole of its largest.
    common = F.when(F.col("rows") > 1, F.col("size")).otherwise(F.col("size") - F.coalesce("rare", F.lit(0)))
    pairs = F.transform("ids", lambda x, i: F.transform(F.slice("ids", i + 2, F.lit(RARE)), lambda y: F.struct(x.alias("a"), y.alias("b"))))
    sharing = holders.filter(F.size("ids") > 1).select(F.inline(F.flatten(pairs)))
    return sizes.select("id", common.alias("common")), sharing.distinct()


def _those_of(wanted: Broadcast):
    """The rows whose id may be wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(_may_hold(wanted.value, batch.column("id")))

    return giving_back(run)


def _in_shared_buckets(bands: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Written (bucket, band, id, first) of buckets with several members, and
    (id, n_shingles, signature) of the classes in them (and of a few others).

    All later work is on these; a class that shares no bucket is in no pair.
    """
    buckets = bands.groupBy("bucket").agg(F.min("id").alias("first"), F.count("*").alias("members")).filter("members > 1")
    shared = written(bands.join(written(buckets.select("bucket", "first"), "near-buckets"), "bucket"), "near-shared")
    classes = classes.select(F.col("rep").alias("id"), "n_shingles", "signature")
    members = classes.mapInArrow(_those_of(_id_bits(shared.select("id"))), classes.schema)
    return shared.select("bucket", "band", "id", "first"), written(members, "near-members")


def _first_members(shared: DataFrame, members: DataFrame) -> DataFrame:
    """Similar pairs of a bucket's first member with each other member."""
    pairs = shared.filter("first < id").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
    short = members.mapInArrow(giving_back(_shortened), "id long, n long, sig binary")

    def side(name: str) -> DataFrame:
        return short.select(F.col("id").alias(name), F.col("n").alias(f"n_{name}"), F.col("sig").alias(f"sig_{name}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    near = both.filter(100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b"))
    return near.select("a", "b", "sig_a", "sig_b").mapInArrow(giving_back(_similar), "a long, b long")


def _open(rows: DataFrame) -> DataFrame:
    """The rows (bucket, band, id, component) of buckets that hold several components, and each one's members."""
    several = rows.groupBy("bucket").agg(
        F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("members")
    )
    several = written(several.filter("x < y").select("bucket", "members"), "near-open-buckets")
    return written(rows.join(several, "bucket"), "near-open")


def _rest_of_buckets(rows: DataFrame, members: DataFrame) -> DataFrame:
    """Similar pairs of different components in open buckets (bucket, id, component, common, members)."""
    rows = (
        rows.withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .join(members, "id")
    )
    every = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda o: F.struct(
            F.least("block", o).alias("i"), F.greatest("block", o).alias("j"), (F.col("block") > o).cast("int").alias("side")
        ),
    )
    spread = rows.withColumn("at", F.explode(every)).select(
        "bucket", "band", "at.i", "at.j", "at.side", "id", "component", "n_shingles", "common", "signature"
    )
    dealt = spread.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "side")
    return dealt.mapInArrow(giving_back(_between_blocks), "a long, b long")


def near_duplicate_components(docs: DataFrame, k: int) -> DataFrame:
    """One row per row of ``docs`` (id, text): id, n_shingles, component."""
    docs = docs.select(F.col("id").cast("long").alias("id"), "text")
    sketch = written(
        docs.mapInArrow(_sketch(k), "id long, n_shingles long, print_a long, print_b long, signature binary"), "near-sketch"
    )
    prints = ["n_shingles", "print_a", "print_b"]
    real = sketch.filter("id IS NOT NULL AND n_shingles > 0")
    classes = written(
        real.groupBy(*prints).agg(F.min(F.struct("id", "signature")).alias("m")).select(*prints, F.col("m.id").alias("rep"), "m.signature"),
        "near-classes",
    )
    bands = written(
        classes.select(F.col("rep").alias("id"), "signature").mapInArrow(giving_back(_band_rows), "bucket long, band int, id long"), "near-bands"
    )
    shared, members = _in_shared_buckets(bands, classes)
    # Rows that share an id but not a set: their classes belong together.
    own = real.select("id", *prints).join(classes.select(*prints, "rep"), prints).select("id", "rep").distinct()
    lowest = own.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).filter("a < b").select("id", "a")
    same_id = own.join(lowest, "id").filter("a < rep").select("a", F.col("rep").alias("b"))
    first = written(_first_members(shared, members), "near-candidates")
    sets = _full_sets(docs, first.select(F.col("a").alias("id")).unionByName(first.select(F.col("b").alias("id"))), k)
    links = written(_confirmed(first, sets).unionByName(same_id), "near-links")
    labels = components(links)
    rows = shared.join(labels.select(F.col("node").alias("id"), "component"), "id", "left")
    rows = _open(written(rows.select("bucket", "band", "id", F.coalesce("component", "id").alias("component")), "near-bucket-components"))
    sets = _full_sets(docs, rows.select("id"), k)
    common, sharing = _by_rarity(sets)
    sizes = members.select("id", "n_shingles")
    possible = written(common.join(sizes, "id").filter(100 * F.col("common") >= PERCENT * F.col("n_shingles")), "near-common")
    rest = _open(rows.drop("members").join(possible.select("id", "common"), "id"))
    known = written(rows.select("id", "component").distinct(), "near-open-components")
    for side in ("a", "b"):
        mine = known.join(sizes, "id").select(F.col("id").alias(side), F.col("component").alias(f"c_{side}"), F.col("n_shingles").alias(f"n_{side}"))
        sharing = sharing.join(mine, side)
    sharing = sharing.filter(F.col("c_a") != F.col("c_b")).filter(100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b"))
    more = written(sharing.select("a", "b").unionByName(_rest_of_buckets(rest, members)).distinct(), "near-candidates")
    links = written(links.unionByName(_confirmed(more, sets)), "near-links")
    labels = components(links)
    known = classes.select(*prints, F.col("rep").alias("node")).join(labels, "node", "left")
    known = written(known.select(*prints, F.coalesce("component", "node").alias("component")), "near-labels")
    found = sketch.select("id", *prints).join(known, prints, "left")
    return found.select("id", "n_shingles", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"))


def near_duplicates(docs: DataFrame, shingle_words: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``."""
    found = near_duplicate_components(docs.select(F.col("doc_id").alias("id"), "text"), shingle_words)
    return found.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )


def keep_one_of_each(docs: DataFrame, shingle_words: int = 5) -> DataFrame:
    """Of each component the document of the smallest id, all columns of ``docs`` as they are.

    Rows that share an id are one document and stay or go together.
    """
    gone = near_duplicates(docs, shingle_words).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(written(gone, "near-gone"), "doc_id", "left_anti").select(*docs.columns)


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4)
