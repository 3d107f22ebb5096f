"""The driver contract and every registered query against DuckDB (sf0.001)."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from tarmac.catalog import all_queries
from tarmac.schemas import MART_COLUMNS

from .conftest import SF_SMALL
from tools.oracle_check import DRIVER_TABLES, rows_multiset, type_family

QUERIES = all_queries()
ORACLE = {k: v for k, v in entry_module.oracle_sql().items() if k in QUERIES}


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    assert df.columns == MART_COLUMNS
    assert df.count() > 0


def test_every_query_has_oracle_sql():
    assert set(ORACLE) == set(QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        path = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(path):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    rel = duck.sql(ORACLE[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    duck_types = dict(zip(rel.columns, (str(t) for t in rel.types)))
    for field in sdf.schema:
        assert type_family(field.dataType.simpleString()) == type_family(duck_types[field.name]), field.name
    s_rows = [tuple(r) for r in sdf.collect()]
    d_rows = rel.fetchall()
    assert len(s_rows) == len(d_rows)
    assert rows_multiset(sdf.columns, s_rows) == rows_multiset(rel.columns, d_rows)
