"""Comparing registered llm queries with their DuckDB SQL."""

import os

import duckdb

from tarmac.llm.queries import ORACLE_SQL, QUERIES
from tools.oracle_check import DRIVER_TABLES, rows_multiset


def compare(spark, name, sf_dir):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    got = QUERIES[name](spark, sf_dir)
    want = con.sql(ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    got_rows, want_rows = [tuple(r) for r in got.collect()], want.fetchall()
    assert len(got_rows) == len(want_rows)
    assert rows_multiset(got.columns, got_rows) == rows_multiset(want.columns, want_rows)
    return got.columns, got_rows
