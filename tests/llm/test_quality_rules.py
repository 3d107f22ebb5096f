"""Quality rules against SQL, brute force of the counts, and edge cases."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tarmac.llm import quality_rules as Q
from tarmac.llm.tables import table

from ..conftest import SF_ORACLE, SF_SMALL
from .sql import compare

SCHEMA = "doc_id long, text string, lang string, source string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("sf_dir", [SF_SMALL, SF_ORACLE])
def test_query_equals_sql(spark, sf_dir):
    compare(spark, "op1_quality_rules", sf_dir)


def brute_force(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(5)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


TEXTS = [
    None,
    "",
    " \n\t ",
    "one two three four five",
    "a b c d e " * 30,
    "x " * 12,
    "\n".join(["same line here"] * 3 + [" ", "", "other é line\x0b\x0cx", "same line here "]),
    "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w2 w3 w4 w5 w6 tail",
    " ".join(f"u{i}" for i in range(30_000)) + " # * $ <b>",
    "é ü 👍🏽 日本語 " * 4,
]


def test_counts_equal_brute_force(spark):
    docs = [(i, t, "en", "s") for i, t in enumerate(TEXTS)] + [(99, TEXTS[7], None, None), (99, TEXTS[7], None, None), (None, "a " * 11, None, "s")]
    rows = Q.quality_verdicts(spark.createDataFrame(docs, SCHEMA).withColumns({"n_words": F.lit("x"), "docs": F.lit(1)})).collect()
    got = sorted([(str(r[0]), *r[1:7]) for r in rows])
    assert got == sorted((str(d), *brute_force(t)) for d, t, _, _ in docs)
    assert not any(r.kept and r.base_failed for r in rows)


def test_unusual_rates_are_dropped_and_usual_ones_kept(spark):
    plain = [(i, " ".join(f"word{i}{j}" for j in range(20 + i % 30)), "en", "s0" if i % 3 else f"s{i % 7}") for i in range(600)]
    signs = [(1000 + i, " ".join(f"w{i}{j}###" for j in range(40)), "en", "s0") for i in range(20)]
    # where signs are usual they stay
    code = [(2000 + i, " ".join(f"v{i}{j} # $" for j in range(20 + i % 9)), "code", "hub") for i in range(200)]
    kept = {r.doc_id for r in Q.quality_verdicts(spark.createDataFrame(plain + signs + code, SCHEMA)).filter("kept").collect()}
    assert kept == {d[0] for d in plain + code}


def test_sketches_merge(spark):
    rows = table(spark, SF_SMALL, "documents")
    rated = Q._with_rates(Q.with_features(rows.select("lang", "source", "text")))
    parts = Q.sketches(rated, ["lang", "source"])
    assert sorted(Q.merged(parts, ["lang"]).collect()) == sorted(Q.sketches(rated, ["lang"]).select("lang", "rate", "bucket", "n").collect())


def test_keep_by_rules_keeps_columns(spark):
    docs = [(i, t, "en", "s") for i, t in enumerate(TEXTS)]
    frame = spark.createDataFrame(docs, SCHEMA).withColumns({"rules_n_words": F.lit(1), "kept": F.lit("k")})
    kept = Q.keep_by_rules(frame)
    assert kept.columns == frame.columns
    verdicts = {r.doc_id for r in Q.quality_verdicts(frame).filter("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == verdicts
    assert Q.quality_verdicts(spark.createDataFrame([], SCHEMA)).collect() == []


def test_limits_move_with_the_size_of_a_group(spark):
    """Between the language's limits and the group's own, by the group's documents; no size changes them over."""
    plain = [(i, " ".join(f"word{i}{j}" for j in range(20 + i % 30)), "en", "plain") for i in range(400)]
    found = []
    for n in (0, 1, 10, 99, 100, 101, 400):
        signs = [(1000 + i, " ".join(f"word{i}{j}##" for j in range(20 + i % 30)), "en", "signs") for i in range(n)]
        signs.append((5000, "too short", "en", "signs"))  # fails the base rules
        limits = Q.thresholds(Q.with_features(spark.createDataFrame(plain + signs, SCHEMA)))
        found.append(limits.filter("source = 'signs'").first().symbol_rate_max)
    assert found[0] == 200 and found == sorted(found)
    assert found[5] - found[3] < 20 and found[-1] > 1500
