"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

    python tools/oracle_check.py [sf_dir] [name ...]

Compares row count, column names/types and an order-insensitive multiset of
rows (columns sorted by name), the way the driver's gate does.
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.abspath(os.path.join(os.path.dirname(__file__), "..")))

import duckdb  # noqa: E402

from tarmac.catalog import all_queries  # noqa: E402
from tarmac.oracle import oracle_sql  # noqa: E402
from tarmac.session import build_session  # noqa: E402

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return repr(v)


_SPARK_FAMILY = {
    "bigint": "int64", "int": "int32", "smallint": "int16", "tinyint": "int8", "double": "float64",
    "float": "float32", "string": "string", "boolean": "bool", "date": "date",
    "timestamp_ntz": "timestamp", "timestamp": "timestamp",
}
_DUCK_FAMILY = {
    "BIGINT": "int64", "INTEGER": "int32", "SMALLINT": "int16", "TINYINT": "int8", "DOUBLE": "float64",
    "FLOAT": "float32", "VARCHAR": "string", "BOOLEAN": "bool", "DATE": "date", "TIMESTAMP": "timestamp",
}


def type_family(spark_or_duck: str) -> str:
    t = spark_or_duck.strip()
    if t.lower().startswith("decimal"):
        return "decimal"
    return _SPARK_FAMILY.get(t, _DUCK_FAMILY.get(t.upper(), t))


def rows_multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = build_session(master="local[8]", app_name="oracle-check", shuffle_partitions=8)
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    queries = all_queries()
    sqls = oracle_sql()
    bad = 0
    for name in names or list(queries):
        t0 = time.time()
        try:
            sdf = queries[name](spark, sf_dir)
            s_cols = sdf.columns
            s_types = [f.dataType.simpleString() for f in sdf.schema]
            s_rows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"rows-only {name}: {len(s_rows)} rows ({ts:.1f}s)")
            continue
        try:
            rel = con.sql(sqls[name])
            d_cols = rel.columns
            d_types = [str(t) for t in rel.types]
            d_rows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        ok = True
        msgs = []
        if sorted(s_cols) != sorted(d_cols):
            ok = False
            msgs.append(f"columns spark={s_cols} duck={d_cols}")
        if len(s_rows) != len(d_rows):
            ok = False
            msgs.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
        if ok:
            a = rows_multiset(s_cols, s_rows)
            b = rows_multiset(d_cols, d_rows)
            if a != b:
                ok = False
                diff_a = list((a - b).items())[:3]
                diff_b = list((b - a).items())[:3]
                msgs.append(f"values differ: spark-only {diff_a} duck-only {diff_b}")
        types = dict(zip(s_cols, s_types)), dict(zip(d_cols, d_types))
        if ok:
            wrong = {c: (types[0][c], types[1][c]) for c in s_cols if type_family(types[0][c]) != type_family(types[1][c])}
            if wrong:
                ok = False
                msgs.append(f"type families differ: {wrong}")
        status = "OK  " if ok else "FAIL"
        bad += not ok
        print(f"{status} {name}: {len(s_rows)} rows ({ts:.1f}s) types spark={types[0]} duck={types[1]}")
        for m in msgs:
            print("     ", m[:1500])
    print(f"{bad} failing")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
