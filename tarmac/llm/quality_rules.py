"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Base rules are fixed.  The adaptive rules compare four rates of a document
with those usual for its language and source.  The usual rates come from
sketches: histograms whose buckets keep the leading ``SKETCH_BITS`` bits of a
value (a relative error of at most 1/32), so that sketches merge by adding
counts.  The sketches of a language and source merge into those of the language
and of the whole table.  A group's limits are the mean of its own, weighed by
its documents that passed the base rules, and of its language's, weighed as
``PRIOR_DOCS`` documents; a language's likewise of its own and the table's.  So
limits move from the table's to the group's own as a group grows, without a
size at which they change over.  A rate is unusual if it lies further outside the
quartiles than ``SPREAD`` times their distance, and than a margin that keeps
uniform groups from rejecting small differences.

All of it is DataFrame operations; the sketches are at most a few hundred rows
for each language, source and rate, whatever the number of documents.

Defined results: a null or empty text has no words and fails the base rules; a
null language or source is a group of its own; repeated rows are each judged;
empty tables give no rows; extra columns are ignored or, by ``keep_by_rules``,
kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.llm.tables import SEPARATORS, WORD, table, written

MIN_WORDS, REPEATED_PERCENT, REPEAT_WINDOW = 10, 20, 5
SYMBOLS = "#*$%&|<>"
SKETCH_BITS = 6
#: Documents that the limits of the larger group count for beside a group's own.
PRIOR_DOCS = 50
SPREAD = 6

#: Rate: (value, margin below or None, margin above or None), integers.
RATES: dict[str, tuple[str, int | None, int | None]] = {
    "symbol_rate": ("1000 * n_symbols div n_words", None, 200),
    "dup_line_rate": ("1000 * n_dup_lines div n_lines", None, 300),
    "repeat_rate": ("1000 * n_repeat_words div n_words", None, 100),
    "word_length": ("100 * word_chars div n_words", 400, 400),
}


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(words: Column, window: int = REPEAT_WINDOW) -> Column:
    """Words inside windows that occur twice or more among ``words``."""

    def hashes(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - window)
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(window)]))

    def repeated_starts(by_hash: Column) -> Column:
        same = lambda x, k: (x["h"] == F.get(by_hash, k - 1)["h"]) | (x["h"] == F.get(by_hash, k + 1)["h"])
        return F.array_sort(F.filter(F.transform(by_hash, lambda x, k: F.when(same(x, k), x["i"])), F.isnotnull))

    def covered(starts: Column) -> Column:
        empty = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        step = lambda a, i: F.struct(
            (a["n"] + i + window - F.greatest(i, a["end"])).alias("n"), (i + window).alias("end")
        )
        return F.aggregate(starts, empty, step)["n"]

    def count(h: Column) -> Column:
        by_hash = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(_let(by_hash, repeated_starts)))

    return _let(words, lambda w: F.when(F.size(w) < window, 0).otherwise(_let(hashes(w), count)))


def with_features(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_lines."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(WORD))
    counted = docs.withColumn(f"{prefix}words", F.regexp_extract_all(body, F.lit(WORD), F.lit(0))).withColumn(f"{prefix}lines", lines)
    words, lines = F.col(f"{prefix}words"), F.col(f"{prefix}lines")
    features = {
        "n_words": F.size(words),
        "word_chars": F.length(F.regexp_replace(body, SEPARATORS, "")),
        "n_symbols": F.length(body) - F.length(F.translate(body, SYMBOLS, "")),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": _repeated_words(words),
        "n_lines": F.size(lines),
    }
    out = counted.withColumns({f"{prefix}{k}": v.cast("long") for k, v in features.items()})
    return out.drop(f"{prefix}words", f"{prefix}lines")


def _base_failed(prefix: str = "") -> Column:
    n, repeated = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (n < MIN_WORDS) | (100 * repeated > REPEATED_PERCENT * n)


def _with_rates(rows: DataFrame, prefix: str = "") -> DataFrame:
    rates = {}
    for name, (value, _, _) in RATES.items():
        for part in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"):
            value = " ".join(f"{prefix}{part}" if x == part else x for x in value.split())
        rates[f"{prefix}{name}"] = F.when(F.col(f"{prefix}n_words") > 0, F.expr(value))
    return rows.withColumns(rates)


def _bucket(value: Column) -> Column:
    """The value with all but its leading bits cleared."""
    spare = F.greatest(F.length(F.bin(value)) - SKETCH_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, spare), spare)


def sketches(rows: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, rate, bucket, n): the mergeable sketches of ``rows``' rates."""
    each = F.array(*[F.struct(F.lit(name).alias("rate"), F.col(name).alias("value")) for name in RATES])
    long = rows.select(*groups, F.explode(each).alias("x")).select(*groups, "x.rate", _bucket(F.col("x.value")).alias("bucket"))
    return long.groupBy(*groups, "rate", "bucket").agg(F.count("*").alias("n"))


def merged(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """The sketches merged into fewer groups: counts add up."""
    return sketch.groupBy(*groups, "rate", "bucket").agg(F.sum("n").alias("n"))


def _limits(sketch: DataFrame, groups: list[str], mark: str) -> DataFrame:
    """One row for each group: its documents and each rate's lower and upper limit."""
    own = Window.partitionBy(*groups, "rate")
    up_to = own.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = sketch.withColumn("docs", F.sum("n").over(own)).withColumn("up_to", F.sum("n").over(up_to))
    quartiles = ranked.groupBy(*groups, "rate").agg(
        F.max("docs").alias("docs"),
        F.min(F.when(4 * F.col("up_to") >= F.col("docs"), F.col("bucket"))).alias("low"),
        F.min(F.when(4 * F.col("up_to") >= 3 * F.col("docs"), F.col("bucket"))).alias("high"),
    )
    out = [F.max("docs").alias(f"{mark}docs")]
    for name, (_, below, above) in RATES.items():
        mine, spread = F.col("rate") == name, SPREAD * (F.col("high") - F.col("low"))
        if below is not None:
            out.append(F.max(F.when(mine, F.col("low") - F.greatest(spread, F.lit(below)))).alias(f"{mark}{name}_min"))
        if above is not None:
            out.append(F.max(F.when(mine, F.col("high") + F.greatest(spread, F.lit(above)))).alias(f"{mark}{name}_max"))
    return quartiles.groupBy(*groups).agg(*out)


def _limit_names() -> list[str]:
    return [f"{name}_{end}" for name, (_, *ends) in RATES.items() for end, margin in zip(("min", "max"), ends) if margin is not None]


def _blended(docs: Column, own: Column, prior: Column) -> Column:
    """The mean of a group's own limit and its larger group's; integers, rounded towards zero."""
    mean = F.call_function("div", docs * own + PRIOR_DOCS * prior, docs + PRIOR_DOCS)
    return F.coalesce(mean, prior)


def thresholds(features: DataFrame) -> DataFrame:
    """lang, source and the limits of each rate, from the rows that pass the base rules.

    A group without such rows takes its language's limits, or else those of all rows.
    """
    passed = features.filter(~_base_failed())
    own = written(sketches(_with_rates(passed), ["lang", "source"]), "rules-sketch")
    by_lang = _limits(merged(own, ["lang"]), ["lang"], "l_").withColumnRenamed("lang", "l_lang")
    whole = _limits(merged(own.withColumn("one", F.lit(1)), ["one"]), ["one"], "w_").drop("one")
    every = features.select("lang", "source").distinct()
    own_limits = _limits(own, ["lang", "source"], "s_").withColumnsRenamed({"lang": "s_lang", "source": "s_source"})
    joined = (
        every.join(own_limits, F.col("lang").eqNullSafe(F.col("s_lang")) & F.col("source").eqNullSafe(F.col("s_source")), "left")
        .join(by_lang, F.col("lang").eqNullSafe(F.col("l_lang")), "left")
        .join(F.broadcast(whole), F.lit(True), "left")  # one row
    )
    pick = []
    for c in _limit_names():
        lang = _blended(F.col("l_docs"), F.col(f"l_{c}"), F.col(f"w_{c}"))
        pick.append(_blended(F.col("s_docs"), F.col(f"s_{c}"), lang).alias(c))
    return joined.select("lang", "source", *pick)


def _kept(prefix: str = "") -> Column:
    rules = [~_base_failed(prefix)]
    for limit in _limit_names():
        rate, end = limit.rsplit("_", 1)
        value, bound = F.col(f"{prefix}{rate}"), F.col(f"{prefix}{limit}")
        rules.append(F.coalesce(value >= bound if end == "min" else value <= bound, F.lit(True)))
    return reduce(lambda a, b: a & b, rules)


def _joined(rows: DataFrame, limits: DataFrame, prefix: str = "") -> DataFrame:
    """Rows with their group's limits; the limits are a written table, so a hot group is split by the skew join."""
    limits = written(limits, "rules-limits")
    named = limits.select([F.col(c).alias(f"{prefix}limit_{c}" if c in ("lang", "source") else f"{prefix}{c}") for c in limits.columns])
    same = F.col("lang").eqNullSafe(F.col(f"{prefix}limit_lang")) & F.col("source").eqNullSafe(F.col(f"{prefix}limit_source"))
    return rows.join(named, same, "left")


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """Features, base verdict and final verdict of every row of ``docs`` (doc_id, text, lang, source)."""
    features = written(with_features(docs.select("doc_id", "lang", "source", "text")).drop("text"), "rules-features")
    judged = _joined(_with_rates(features), thresholds(features))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *counts, _base_failed().alias("base_failed"), _kept().alias("kept"), *RATES, *_limit_names())


def keep_by_rules(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that the rules keep."""
    prefix = "rules_"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix = f"_{prefix}"
    limits = thresholds(written(with_features(docs.select("lang", "source", "text")).drop("text"), "rules-features"))
    judged = _joined(_with_rates(with_features(docs, prefix=prefix), prefix), limits, prefix)
    return judged.filter(_kept(prefix)).select(*docs.columns)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents"))


def _sql() -> str:
    """DuckDB SQL of the query; the limits are written from the same rates and margins."""
    rates = ",\n         ".join(
        f"CASE WHEN n_words > 0 THEN {value.replace('div', '//')} END AS {name}" for name, (value, _, _) in RATES.items()
    )
    values = " UNION ALL ".join(f"SELECT lang, source, '{name}' AS rate, {name} AS value FROM rated WHERE NOT base_failed" for name in RATES)

    def limits(groups: list[str], name: str) -> str:
        by = "".join(f"{g}, " for g in groups)
        out = ["max(docs) AS docs"]
        for rate, (_, below, above) in RATES.items():
            if below is not None:
                out.append(f"max(CASE WHEN rate = '{rate}' THEN low - greatest({SPREAD} * (high - low), {below}) END) AS {rate}_min")
            if above is not None:
                out.append(f"max(CASE WHEN rate = '{rate}' THEN high + greatest({SPREAD} * (high - low), {above}) END) AS {rate}_max")
        return f"""{name} AS (
  SELECT {by}{', '.join(out)} FROM (
    SELECT {by}rate, max(docs) AS docs, min(bucket) FILTER (4 * up_to >= docs) AS low, min(bucket) FILTER (4 * up_to >= 3 * docs) AS high
    FROM (SELECT {by}rate, bucket, sum(n) OVER (PARTITION BY {by}rate) AS docs, sum(n) OVER (PARTITION BY {by}rate ORDER BY bucket) AS up_to
          FROM (SELECT {by}rate, bucket, sum(n) AS n FROM sketch GROUP BY {by}rate, bucket))
    GROUP BY {by}rate)
  {'GROUP BY ' + ', '.join(groups) if groups else ''})"""

    picks, tests = [], []
    for limit in _limit_names():
        rate, end = limit.rsplit("_", 1)
        lang = f"coalesce((l.docs * l.{limit} + {PRIOR_DOCS} * w.{limit})::BIGINT // (l.docs + {PRIOR_DOCS})::BIGINT, w.{limit})::BIGINT"
        picks.append(f"coalesce((s.docs * s.{limit} + {PRIOR_DOCS} * {lang})::BIGINT // (s.docs + {PRIOR_DOCS})::BIGINT, {lang})::BIGINT AS {limit}")
        tests.append(f"coalesce({rate} {'>=' if end == 'min' else '<='} {limit}, true)")
    word = r"[^\x20\x09-\x0D]"
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT *, regexp_extract_all(text, '{word}+') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{word}')) AS lines
  FROM texts
), windows AS (
  SELECT rid, i, words[i:i + {REPEAT_WINDOW - 1}] AS w
  FROM (SELECT rid, words, unnest(range(1, len(words) - {REPEAT_WINDOW - 2})) AS i FROM split)
), repeated AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, w) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT rid, count(DISTINCT i + j) AS n FROM repeated, range({REPEAT_WINDOW}) t(j) GROUP BY rid
), features AS (
  SELECT s.rid, doc_id, lang, source, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[{SYMBOLS}]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines)::BIGINT AS n_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM split s LEFT JOIN covered c ON s.rid = c.rid
), rated AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEATED_PERCENT} * n_words AS base_failed,
         {rates}
  FROM features
), sketch AS (
  SELECT lang, source, rate, (value >> spare) << spare AS bucket, count(*) AS n
  FROM (SELECT *, greatest(length(bin(value)) - {SKETCH_BITS}, 0)::BIGINT AS spare FROM ({values}))
  GROUP BY ALL
), {limits(['lang', 'source'], 's')},
{limits(['lang'], 'l')},
{limits([], 'w')},
judged AS (
  SELECT r.*, {', '.join(picks)}
  FROM rated r
  LEFT JOIN s ON r.lang IS NOT DISTINCT FROM s.lang AND r.source IS NOT DISTINCT FROM s.source
  LEFT JOIN l ON r.lang IS NOT DISTINCT FROM l.lang
  LEFT JOIN w ON true
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {' AND '.join(tests)} AS kept,
       {', '.join(f'{x}::BIGINT AS {x}' for x in RATES)}, {', '.join(_limit_names())}
FROM judged
"""


SQL = _sql()
