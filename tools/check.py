"""Compare registered queries with their DuckDB text on one data folder.

    python tools/check.py [--sf DIR] [--cpus N] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from ledgerlens.plans import catalog  # noqa: E402
from ledgerlens.session import build  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return v


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in data]
    return [cols[i] for i in order], sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--cpus", default="8")
    ap.add_argument("--skip", default="")
    ap.add_argument("prefix", nargs="*")
    a = ap.parse_args()
    spark, con = build(cores=a.cpus), connect(a.sf)
    bad = 0
    for name, q in catalog.QUERIES.items():
        if name in a.skip.split(","):
            continue
        if a.prefix and not any(name.startswith(p) for p in a.prefix):
            continue
        t = time.time()
        try:
            df = q.build(spark, a.sf)
            got_cols, got = rows(df.columns, [tuple(r) for r in df.collect()])
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: {type(e).__name__}: {str(e)[:600]}", flush=True)
            bad += 1
            continue
        took = time.time() - t
        if q.sql is None:
            print(f"rows {name}: {len(got)} rows {took:.2f}s {got[:2]}", flush=True)
            continue
        try:
            t = time.time()
            cur = con.execute(q.sql)
            want_cols, want = rows([d[0] for d in cur.description], cur.fetchall())
            duck = time.time() - t
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name} SQL: {str(e)[:600]}", flush=True)
            bad += 1
            continue
        if got_cols == want_cols and got == want:
            print(f"ok   {name}: {len(got)} rows {took:.2f}s duck {duck:.2f}s", flush=True)
        else:
            bad += 1
            diff = [(x, y) for x, y in zip(got, want) if x != y]
            print(f"DIFF {name}: rows {len(got)} vs {len(want)}, {len(diff)} differ; {got_cols} {want_cols}", flush=True)
            for x, y in diff[:3]:
                print("   spark", x, "\n   duck ", y, flush=True)
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
