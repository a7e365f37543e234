"""Run queries() against oracle_sql() the way the driver does (local check).

Usage: python tests/oracle_compare.py [--plain] [sf_dir] [key ...]

Compares row count, column names, column types (Spark -> DuckDB names) and the
order-insensitive values. ``--plain`` uses a default SparkSession instead of
``mallscope.get_session`` (as a caller's session might be).
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "smallint": "SMALLINT", "tinyint": "TINYINT", "float": "FLOAT",
                 "date": "DATE"}


def type_mismatches(df, rel) -> list:
    duck = {c[0]: str(c[1]) for c in rel.description}
    out = []
    for name, t in df.dtypes:
        want = SPARK_TO_DUCK.get(t, t.upper())
        got = duck.get(name)
        if got is not None and got.upper() != want:
            out.append((name, t, got))
    return out


def _norm(v):
    if v is None:
        return ("~null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return ("num", float(f"{v:.10g}"))
    if isinstance(v, bool):
        return ("num", float(v))
    if isinstance(v, int):
        return ("num", float(v))
    if hasattr(v, "item"):
        return _norm(v.item())
    return ("s", str(v))


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, sf_dir, keys=None, verbose=True):
    import __spark_entry__ as E
    qs, sq = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for k in keys or list(qs):
        t0 = time.time()
        try:
            df = qs[k](spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            results[k] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            print(k, results[k])
            continue
        t1 = time.time()
        if k not in sq:
            results[k] = f"rows-only ({len(s_rows)} rows)"
            print(f"{k:28s} {results[k]}")
            continue
        try:
            rel = con.execute(sq[k])
            d_cols = [c[0] for c in rel.description]
            d_rows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            results[k] = f"DUCK ERROR {str(e)[:300]}"
            print(k, results[k])
            continue
        bad_types = type_mismatches(df, rel)
        if bad_types:
            print(f"   TYPES {k}: {bad_types}")
        ok_cols = sorted(s_cols) == sorted(d_cols)
        ok_n = len(s_rows) == len(d_rows)
        ok_v = ok_cols and rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)
        results[k] = "OK" if (ok_cols and ok_n and ok_v and not bad_types) else \
            f"MISMATCH cols={ok_cols} n={len(s_rows)}/{len(d_rows)} vals={ok_v} types={bad_types}"
        if verbose:
            print(f"{k:28s} {results[k]:40s} spark {t1 - t0:5.2f}s rows={len(s_rows)}")
            if not ok_cols:
                print("   spark cols", s_cols, "\n   duck cols ", d_cols)
            elif not ok_v:
                a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
                sa, sb = set(a), set(b)
                print("   spark-only", sorted(sa - sb)[:3])
                print("   duck-only ", sorted(sb - sa)[:3])
    return results


if __name__ == "__main__":
    args = [a for a in sys.argv[1:] if a != "--plain"]
    sf = args[0] if args else "/root/testdata/sf0.01"
    keys = args[1:] or None
    if "--plain" in sys.argv:      # a default session, as a caller might bring
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[*]").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        from mallscope.session import get_session
        spark = get_session("local[8]", shuffle_partitions=8)
    res = compare(spark, sf, keys)
    bad = {k: v for k, v in res.items() if not (v == "OK" or v.startswith("rows-only"))}
    print(f"{len(res) - len(bad)}/{len(res)} ok")
    for k, v in bad.items():
        print("  BAD", k, v)
