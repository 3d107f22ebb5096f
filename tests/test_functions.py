"""Scalar expressions: name cleaning, time parts, ANSI-safe arithmetic."""

from decimal import Decimal

from pyspark.sql import functions as F

from tarmac.functions import (
    AIRPORT_NAME_PATTERN,
    CITY_NAME_PATTERN,
    day_period,
    localized_name,
    percent_of,
    round2,
    seconds_between,
    truncate_to_long,
)


def _one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_airport_name_leading_words(spark):
    cases = {
        '{"en": "Ulan-Ude Airport (Mukhino)"}': "Ulan-Ude Airport",
        '{"en": "NATION_0"}': "NATION",
        '{"en": "O\'Hare Airport"}': "O",
        '{"en": "São Paulo"}': "S",
        '{"en": " Leading space"}': "",
        '{"en": "Double  space"}': "Double",
        '{"en": "A. B-C d"}': "A. B-C d",
        '{"ru": "Пулково", "en": "Pulkovo"}': "Пулково",
        '{"en": null, "ru": "Внуково"}': "Внуково",
        "[1, 2]": "",
        "{broken": "",
        "{}": "",
    }
    rows = [(k,) for k in cases] + [(None,)]
    got = _one(spark, rows, "j string", localized_name(F.col("j"), AIRPORT_NAME_PATTERN))
    assert got == list(cases.values()) + [""]


def test_city_name_at_most_two_words(spark):
    got = _one(spark, [('{"en": "St. Petersburg Big City"}',), ('{"en": "Москва"}',)], "j string",
               localized_name(F.col("j"), CITY_NAME_PATTERN))
    assert got == ["St. Petersburg", ""]


def test_day_period_boundaries(spark):
    hours = [0, 5, 6, 11, 12, 17, 18, 23, None]
    got = _one(spark, [(h,) for h in hours], "h int", day_period(F.col("h")))
    assert got == ["Early Morning", "Early Morning", "Morning", "Morning", "Afternoon", "Afternoon",
                   "Evening", "Evening", None]


def test_seconds_between_drops_fractions(spark):
    df = spark.sql(
        "SELECT TIMESTAMP_NTZ'2020-01-01 00:00:59.900' AS a, TIMESTAMP_NTZ'2020-01-01 00:00:00.100' AS b"
    )
    assert df.select(seconds_between(F.col("a"), F.col("b"))).first()[0] == 59


def test_truncate_and_round(spark):
    rows = [(Decimal("-10.99"), 1.005), (Decimal("10.99"), 2.675), (Decimal("0.50"), -0.125)]
    df = spark.createDataFrame(rows, "d decimal(12,2), x double")
    got = [tuple(r) for r in df.select(truncate_to_long(F.col("d")), round2(F.col("x"))).collect()]
    assert got == [(-10, 1.01), (10, 2.68), (0, -0.13)]


def test_percent_of_zero_and_null_is_null_not_error(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (None, 5), (2, 3)], "p long, s long")
    got = [r[0] for r in df.select(percent_of(F.col("p"), F.col("s"))).collect()]
    assert got == [None, None, None, 66.67]
