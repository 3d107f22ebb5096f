"""Relational building blocks: joins that spread hot keys, filters, aggregates."""

from tarmac.operators.joins import (
    left_join,
    left_join_fanout,
    left_join_few_codes,
    left_join_unique,
    split_left_join,
)
from tarmac.operators.relational import (
    conditional_counts,
    drop_null_rows,
    fill_null_numeric,
    filter_equals,
    range_predicate,
    union_distinct,
)

__all__ = [
    "conditional_counts",
    "drop_null_rows",
    "fill_null_numeric",
    "filter_equals",
    "left_join",
    "left_join_fanout",
    "left_join_few_codes",
    "left_join_unique",
    "range_predicate",
    "split_left_join",
    "union_distinct",
]
