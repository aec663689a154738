"""Run each job in Spark and its SQL in DuckDB on the same tables; compare.

Usage: python tests/oracle_compare.py [sf_dir] [job-substring ...]
Prints one line per job: rows, column names and an order-insensitive
comparison of all values.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(sorted((k, _norm(x)) for k, x in v.asDict().items()))
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def duck_connection(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir, keys=None):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck_connection(sf_dir)
    results = {}
    for name, fn in sorted(qs.items()):
        if keys and not any(k in name for k in keys):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            s_names = df.columns
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as exc:  # report and go on
            results[name] = f"SPARK ERROR {type(exc).__name__}: {str(exc)[:300]}"
            print(name, results[name], flush=True)
            continue
        t_spark = time.time() - t0
        if name not in sqls:
            results[name] = f"rows-only {len(s_rows)} rows ({t_spark:.1f}s)"
            print(name, results[name], flush=True)
            continue
        try:
            rel = con.sql(sqls[name])
            d_names = rel.columns
            d_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
            d_rows = rel.fetchall()
        except Exception as exc:
            results[name] = f"SQL ERROR {type(exc).__name__}: {str(exc)[:300]}"
            print(name, results[name], flush=True)
            continue
        ok_cols = sorted(s_names) == sorted(d_names)
        spark_to_duck = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                         "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
        type_diff = {c: (t, d_types.get(c)) for c, t in df.dtypes
                     if spark_to_duck.get(t, t) != d_types.get(c)}
        if type_diff:
            print("  TYPES differ:", type_diff)
        a, b = rows_of(s_names, s_rows), rows_of(d_names, d_rows)
        ok_vals = a == b
        status = "MATCH" if ok_cols and ok_vals and len(a) == len(b) else "DIFF"
        results[name] = f"{status} rows {len(s_rows)}/{len(d_rows)} cols {'ok' if ok_cols else (sorted(s_names), sorted(d_names))} ({t_spark:.1f}s)"
        print(name, results[name], flush=True)
        if status == "DIFF" and ok_cols:
            sa, sb = set(a), set(b)
            print("  spark-only:", list(sa - sb)[:3])
            print("  duck-only: ", list(sb - sa)[:3])
    return results


if __name__ == "__main__":
    from blogweave.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    compare(spark, sf, sys.argv[2:] or None)
