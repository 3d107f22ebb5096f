"""Mixing sources to target weights by hash-threshold histograms.

A document's size is its number of words.  A source's target is its share, by
weight, of the budget (``BUDGET`` times all sizes), capped at ``MOST`` times
its size; what a cap leaves over is shared again by weight.  A target is taken
as so many whole rounds of the source and a rest.  The rest takes documents in
the order of their hash, each that brings the sum nearer.  Where this ends is
found without sorting: sizes are summed by source and leading hash bits, the
bucket in which the sum passes the rest is the boundary bucket, and only its
documents are read and summed again by the next bits, ``LEVELS`` times.
Documents below the last boundary, a single hash, are taken.  Rows that share
that hash (repeats of one row) are numbered within parts of the table, and parts
by their sums, so that as many are taken as the rest asks for.  Thresholds are
nested: a larger budget takes a superset.

The hash is of the id and the text's md5, part of md5, so SQL can repeat it, and
reruns agree.

Defined results: a null text, or one without words, has size 0 and is taken 0
words; a null source is a source, the last; a source of size 0 has target 0;
rows of the same or a null id differ in hash if their texts do; repeated rows
are each counted, and which of them is taken is open, how many is not; empty
tables give no rows; extra columns are ignored or, by ``mix``, kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.llm.tables import WORD, table, written

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MOST = 2
#: Hash bits of one level of the histograms, and the number of levels.
LEVEL_BITS, LEVELS = 12, 4


def _hash(doc_id: Column, text: Column) -> Column:
    """48 bits of md5 of the id's text and the text's md5."""
    name = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|mix|"), F.coalesce(F.md5(text), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, LEVEL_BITS * LEVELS // 4), 16, 10).cast("long")


def _size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _targets(sizes: DataFrame) -> DataFrame:
    """``sizes`` (source, source_size) with each source's target.

    Filling by weight up to caps has one level: a source gets ``level`` times
    its weight or its cap.  Ordered by cap over weight, the sources up to some
    place are capped and the others share the rest.  That place is the first at
    which the next source stays below its cap; capping more lowers the level, so
    it is the largest of the levels that fit.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.lit(WEIGHTS[0])
    for i, w in enumerate(WEIGHTS[1:], start=1):
        weight = F.when(F.col("place") % len(WEIGHTS) == i, w).otherwise(weight)
    ranked = sizes.withColumn("place", F.row_number().over(by_name) - 1).withColumn("weight", weight)
    ranked = ranked.withColumn("most", MOST * F.col("source_size")).withColumn("ratio", F.col("most") / F.col("weight"))
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding, -1)
    shared = ranked.withColumns(
        {
            "left": BUDGET * F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0)),
            "weights_left": F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        }
    )
    # The level if exactly the sources before this one are capped; it is reached where it fits under this one's cap.
    tried = shared.withColumn("level", F.when(F.col("left") / F.col("weights_left") <= F.col("ratio"), F.col("left") / F.col("weights_left")))
    level = F.coalesce(F.max("level").over(every), F.lit(float("inf")))
    target = F.least(F.col("most").cast("double"), level * F.col("weight"))
    return tried.withColumn("level", level).select("source", "source_size", F.when(F.col("most") == 0, F.lit(0.0)).otherwise(target).alias("target"))


def _in_boundary(rows: DataFrame, boundary: DataFrame, shift: int) -> DataFrame:
    """The rows whose hash, without its last ``shift`` bits, is their source's boundary prefix."""
    same = boundary.select(F.col("source").alias("s"), "prefix")
    inside = rows.join(same, F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("hash", shift) == F.col("prefix")))
    return written(inside.select(*rows.columns), "mix-inside")


def _thresholds(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """source, source_size, target, rounds, rest, threshold and below (words of the hashes under the threshold)."""
    now = targets.withColumn("rounds", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    now = now.withColumn("rest", F.col("target") - F.col("rounds") * F.col("source_size"))
    now = written(now.withColumns({"prefix": F.lit(0).cast("long"), "below": F.lit(0).cast("long")}), "mix-targets")
    inside = rows.select("source", "size", "hash")
    for level in range(LEVELS):
        shift = LEVEL_BITS * (LEVELS - 1 - level)
        if level:
            inside = _in_boundary(inside, now, shift + LEVEL_BITS)
        # At most 2**LEVEL_BITS sums for each source, whatever the number of its documents.
        sums = inside.groupBy("source", F.shiftright("hash", shift).alias("bucket")).agg(F.sum("size").alias("size"))
        same = now.select(F.col("source").alias("s"), "rest", F.col("below").alias("start"))
        before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        mine = sums.join(same, F.col("source").eqNullSafe(F.col("s"))).withColumn(
            "up_to", F.col("start") + F.coalesce(F.sum("size").over(before), F.lit(0))
        )
        # The boundary: the last bucket that begins below the rest.
        found = (
            mine.filter("up_to < rest")
            .groupBy("source")
            .agg(F.max(F.struct("bucket", "up_to")).alias("b"))
            .select(F.col("source").alias("s"), F.col("b.bucket").alias("found"), F.col("b.up_to").alias("up_to"))
        )
        now = now.join(found, F.col("source").eqNullSafe(F.col("s")), "left").select(
            "source",
            "source_size",
            "target",
            "rounds",
            "rest",
            F.coalesce("found", F.lit(0).cast("long")).alias("prefix"),
            F.coalesce("up_to", "below").alias("below"),
        )
        now = written(now, "mix-boundary")
    return now.withColumnRenamed("prefix", "threshold")


def _sized(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", _size(F.col("text")).alias("size"), _hash(F.col("doc_id"), F.col("text")).alias("hash"))


def mixing_plan(sized: DataFrame) -> DataFrame:
    """One row for each source (of rows source, size, hash): sizes, target, rounds, rest, threshold, below."""
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    return _thresholds(sized, _targets(sizes))


def _with_plan(rows: DataFrame, plan: DataFrame, prefix: str = "") -> DataFrame:
    """``rows`` joined to their source's plan; a hot source is split by the skew join (the plan is a written table)."""
    named = plan.select(*[F.col(c).alias(f"{prefix}{c}") for c in plan.columns if c != "source"], F.col("source").alias(f"{prefix}of"))
    return rows.join(named, F.col("source").eqNullSafe(F.col(f"{prefix}of")), "left").drop(f"{prefix}of")


def _with_times(rows: DataFrame, prefix: str = "") -> DataFrame:
    """Rows (with size, hash and their source's plan, so prefixed) and ``times``, how often each is taken."""
    name = lambda c: f"{prefix}{c}"
    size, hashed, threshold, rounds = (F.col(name(c)) for c in ("size", "hash", "threshold", "rounds"))
    plain = rows.filter(hashed != threshold).withColumn(name("times"), rounds + (hashed < threshold).cast("long"))
    # Rows of the boundary hash: numbered within their part of a written table, parts by running sums.
    part, number, before = name("part"), name("number"), name("before")
    tied = written(rows.filter(hashed == threshold).withColumn(part, F.spark_partition_id()), "mix-tied")
    parts = tied.groupBy(F.col("source").alias(name("s")), size.alias(name("z")), F.col(part).alias(name("p"))).agg(F.sum(size).alias(name("words")))
    ordered = Window.partitionBy(name("s")).orderBy(name("z"), name("p")).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(name("s"), name("z"), name("p"), F.coalesce(F.sum(name("words")).over(ordered), F.lit(0)).alias(before))
    own = Window.partitionBy("source", name("size"), part).orderBy(name("size"))
    same = F.col("source").eqNullSafe(F.col(name("s"))) & (size == F.col(name("z"))) & (F.col(part) == F.col(name("p")))
    numbered = tied.withColumn(number, F.row_number().over(own) - 1).join(parts, same)
    left = F.col(name("rest")) - (F.col(name("below")) + F.col(before) + F.col(number) * size)
    counted = numbered.withColumn(name("times"), rounds + (2 * left > size).cast("long"))
    return plain.unionByName(counted.select(*plain.columns))


def mixture(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row of ``docs``; also source and times."""
    sized = written(_sized(docs), "mix-sizes")
    rows = _with_times(_with_plan(sized, mixing_plan(sized)))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"), "source", "times")


def mix(docs: DataFrame) -> DataFrame:
    """The mix itself: rows of ``docs``, all columns as they are, as often as they are taken."""
    prefix = "mix_"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix = f"_{prefix}"
    plan = mixing_plan(written(_sized(docs), "mix-sizes"))
    sized = docs.withColumns({f"{prefix}size": _size(F.col("text")), f"{prefix}hash": _hash(F.col("doc_id"), F.col("text"))})
    rows = _with_times(_with_plan(sized, plan, prefix), prefix)
    return rows.withColumn(f"{prefix}copy", F.explode(F.array_repeat(F.lit(1), F.col(f"{prefix}times").cast("int")))).select(*docs.columns)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents"))


#: DuckDB: the level by trying every number of capped sources, the documents taken by sorting.
SQL = r"""
WITH sized AS (
  SELECT row_number() OVER () AS rid, doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|mix|' || coalesce(md5(text), '')), 1, 12))::BIGINT AS hash
  FROM documents
), sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3] AS weight FROM sizes
), tried AS (
  SELECT a.source, (1.5 * (SELECT sum(source_size) FROM sizes)
                    - coalesce((SELECT sum(2 * b.source_size) FROM ranked b WHERE 2.0 * b.source_size / b.weight < 2.0 * a.source_size / a.weight), 0))
         / (SELECT sum(b.weight) FROM ranked b WHERE 2.0 * b.source_size / b.weight >= 2.0 * a.source_size / a.weight) AS level,
         2.0 * a.source_size / a.weight AS ratio
  FROM ranked a
), targets AS (
  SELECT r.source, source_size,
         least(2.0 * source_size, weight * (SELECT max(level) FROM tried WHERE level <= ratio))::DOUBLE AS target
  FROM ranked r
), rest AS (
  SELECT source, source_size, target,
         CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS rounds
  FROM targets
), ordered AS (
  SELECT d.*, r.source_size, r.target, r.rounds, r.target - r.rounds * r.source_size AS rest,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY hash, d.size, rid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS below
  FROM sized d JOIN rest r ON d.source IS NOT DISTINCT FROM r.source
), counted AS (
  SELECT *, rounds + CASE WHEN 2 * (rest - below) > size THEN 1 ELSE 0 END AS times FROM ordered
)
SELECT doc_id, size, source_size, target, (size * times)::BIGINT AS taken, source, times::BIGINT AS times FROM counted
"""
