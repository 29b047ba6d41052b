"""Run registered queries against their SQL counterparts and compare all values.

    python tests/compare.py [scale factor] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "∅"
    if isinstance(v, float):
        return f"{v:.6g}"
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, name, fn, sql):
    """None when equal, else a description of the difference."""
    df = fn(spark, sf_dir)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    theirs = rows_of(rel.columns, rel.fetchall())
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} != {sorted(rel.columns)}"
    if ours != theirs:
        a, b = set(ours), set(theirs)
        return f"rows {len(ours)} / {len(theirs)}; only ours {sorted(a - b)[:2]}; only theirs {sorted(b - a)[:2]}"
    return None if ours else "EMPTY"


def main():
    from tests.conftest import build_session

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    only = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = build_session(), connect(sf_dir)
    oracle = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            diff = compare(spark, con, sf_dir, name, fn, oracle[name]) if name in oracle else "no SQL"
        except Exception as exc:  # report and go on with the next query
            diff = f"{type(exc).__name__}: {str(exc)[:700]}"
        bad += diff is not None
        print(f"{'ok  ' if diff is None else 'DIFF'} {name} {time.time() - start:.1f}s {diff or ''}", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main()
