"""Small relational operators used by the metric plans.

Each is a thin, declarative DataFrame expression so Catalyst can push filters
into the scan, prune columns and fuse projections.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filter_equals(df: DataFrame, column: str, value) -> DataFrame:
    """Rows where ``column = value`` (NULL never matches)."""
    return df.filter(F.col(column) == F.lit(value))


def not_null(columns: Iterable[str]) -> Column:
    """Conjunction of IS NOT NULL predicates (pushed to the parquet scan,
    unlike ``na.drop`` which becomes an opaque AtLeastNNonNulls)."""
    cond = F.lit(True)
    for name in columns:
        cond = cond & F.col(name).isNotNull()
    return cond


def drop_null_rows(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop rows with NULL in any of ``columns``."""
    return df.filter(not_null(columns))


def fill_null_numeric(df: DataFrame, value: int = 0, subset: list[str] | None = None) -> DataFrame:
    """NULL (and NaN) -> ``value`` in numeric columns; strings untouched."""
    return df.na.fill(value, subset=subset) if subset else df.na.fill(value)


def range_predicate(c: Column, low, high) -> Column:
    """Half-open range ``low <= c < high``."""
    return (c >= F.lit(low)) & (c < F.lit(high))


def conditional_counts(conditions: Mapping[str, Column]) -> list[Column]:
    """``count_if(cond) AS name`` for each entry: several filtered counts in
    one aggregation pass instead of one filter + group + join per class."""
    return [F.count_if(cond).alias(name) for name, cond in conditions.items()]


def union_distinct(first: DataFrame, second: DataFrame) -> DataFrame:
    """Positional UNION (set semantics)."""
    return first.union(second).distinct()
