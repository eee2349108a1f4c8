"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_compare.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


EXACT = False


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if EXACT else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, sf_dir, keys=None, verbose=True):
    from __spark_entry__ import oracle_sql, queries
    qs, sq = queries(), oracle_sql()
    con = duck(sf_dir)
    results = {}
    for k in (keys or list(qs)):
        t0 = time.time()
        df = qs[k](spark, sf_dir)
        s_cols = df.columns
        s_rows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        if k not in sq:
            results[k] = ("rows-only", len(s_rows))
            if verbose:
                print(f"{k:28s} rows-only n={len(s_rows)} spark={t1-t0:.1f}s", flush=True)
            continue
        rel = con.sql(sq[k])
        d_cols = rel.columns
        d_rows = rel.fetchall()
        ok_cols = sorted(s_cols) == sorted(d_cols)
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        ok = ok_cols and a == b
        results[k] = ok
        if verbose:
            print(f"{k:28s} {'OK ' if ok else 'BAD'} spark={len(s_rows)} duck={len(d_rows)} "
                  f"cols={'ok' if ok_cols else (s_cols, d_cols)} t={t1-t0:.1f}s", flush=True)
            if not ok and ok_cols:
                sa, sb = set(a), set(b)
                print("   only spark:", sorted(sa - sb, key=repr)[:3])
                print("   only duck :", sorted(sb - sa, key=repr)[:3])
    return results


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from tickwatch.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    import os
    EXACT = os.environ.get("EXACT") == "1"
    compare(spark, sf, sys.argv[2:] or None)
