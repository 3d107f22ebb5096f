"""Airport dimension: clean names out of the localized JSON columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.names import AIRPORT_NAME_PATTERN, CITY_NAME_PATTERN, localized_name


def clean_airports(airports_data: DataFrame, lang: str | None = None) -> DataFrame:
    """Replace ``airport_name``/``city`` JSON by clean ``airport_name``/``city_name``.

    Output: the other airport columns in their order, then airport_name,
    city_name.  Never NULL: unparseable names become ''.
    """
    keep = [c for c in airports_data.columns if c not in ("airport_name", "city")]
    return airports_data.select(
        *keep,
        localized_name(F.col("airport_name"), AIRPORT_NAME_PATTERN, lang).alias("airport_name"),
        localized_name(F.col("city"), CITY_NAME_PATTERN, lang).alias("city_name"),
    )


def airport_names(airports_data: DataFrame, lang: str | None = None) -> DataFrame:
    """(airport_code, airport_name) for joining rows already grouped by airport code."""
    return clean_airports(airports_data, lang).select("airport_code", "airport_name")
