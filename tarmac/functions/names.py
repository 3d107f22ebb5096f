"""Localized names stored as JSON objects such as {"en": ..., "ru": ...}.

The name kept is the leading run of words of all map values joined in JSON key
order, so in practice the first language listed.  Malformed JSON, NULL and
names that do not start with an accepted character all give ''.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType

# Fixed values -- these must stay exactly as written for results to match.
# Airport names: ASCII letters, Cyrillic U+0400-U+04FF, '.', '-'; words joined
# by one whitespace character, any number of words.
AIRPORT_NAME_PATTERN = r"^([A-Za-z\u0400-\u04FF\.\-]+(?:\s[A-Za-z\u0400-\u04FF\.\-]+)*)"
# City names: ASCII letters, '.', '-'; at most two words.
CITY_NAME_PATTERN = r"^([A-Za-z\.\-]+(?:\s[A-Za-z\.\-]+)?)"
# Separator placed between the values of the localized map.
LOCALIZED_SEPARATOR = " | "

_STRING_MAP = MapType(StringType(), StringType())


def json_to_map(json_col: Column) -> Column:
    """JSON object text -> map<string,string>; anything else -> NULL."""
    return F.from_json(json_col, _STRING_MAP)


def map_values_joined(map_col: Column, sep: str = LOCALIZED_SEPARATOR) -> Column:
    """All values of a map joined in key order; NULL values skipped, NULL map -> ''."""
    return F.concat_ws(sep, F.map_values(map_col))


def leading_words(text: Column, pattern: str) -> Column:
    """Capture group 1 of ``pattern`` anchored at the start; '' when nothing matches."""
    return F.regexp_extract(text, pattern, 1)


def localized_name(json_col: Column, pattern: str, lang: str | None = None) -> Column:
    """Clean name out of a localized JSON column.

    ``lang=None`` keeps the first entry (the documented default); a language
    code such as ``'en'`` picks that entry instead.
    """
    as_map = json_to_map(json_col)
    if lang is None:
        text = map_values_joined(as_map)
    else:
        text = F.coalesce(F.try_element_at(as_map, F.lit(lang)), F.lit(""))
    return leading_words(text, pattern)
