"""Column expressions (built-in Spark functions only, all codegen-friendly)."""

from tarmac.functions.arith import minutes_from_seconds, percent_of, round2, truncate_to_long
from tarmac.functions.names import (
    AIRPORT_NAME_PATTERN,
    CITY_NAME_PATTERN,
    LOCALIZED_SEPARATOR,
    json_to_map,
    leading_words,
    localized_name,
    map_values_joined,
)
from tarmac.functions.timeparts import (
    DAY_PERIODS,
    day_of,
    day_period,
    day_string,
    hour_of_day,
    seconds_between,
)

__all__ = [
    "AIRPORT_NAME_PATTERN",
    "CITY_NAME_PATTERN",
    "DAY_PERIODS",
    "LOCALIZED_SEPARATOR",
    "day_of",
    "day_period",
    "day_string",
    "hour_of_day",
    "json_to_map",
    "leading_words",
    "localized_name",
    "map_values_joined",
    "minutes_from_seconds",
    "percent_of",
    "round2",
    "seconds_between",
    "truncate_to_long",
]
