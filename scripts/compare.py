"""Run registered queries in Spark and their SQL twins in DuckDB; compare.

Usage: python scripts/compare.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from panelforge.plans import load_all  # noqa: E402
from panelforge.session import build_session  # noqa: E402
from panelforge.sources.tables import TABLES  # noqa: E402


def canon(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if hasattr(v, "isoformat"):
        # a midnight and its date are the same; any other time of day shows
        return v.isoformat().removesuffix("T00:00:00")
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(canon(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = sys.argv[2:]
    qs = load_all()
    spark = build_session("local[8]")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    bad = 0
    for name, q in sorted(qs.items()):
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        t0 = time.time()
        try:
            df = q.build(spark, sf)
            rows = [tuple(r) for r in df.collect()]
            cols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL-SPARK {name}: {str(e)[:400]}")
            bad += 1
            continue
        dt = time.time() - t0
        if q.sql is None:
            print(f"rows-only {name}: {len(rows)} rows {dt:.1f}s")
            continue
        try:
            res = con.execute(q.sql)
            ocols = [d[0] for d in res.description]
            orows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL-SQL {name}: {str(e)[:400]}")
            bad += 1
            continue
        if sorted(cols) != sorted(ocols):
            print(f"COLS {name}: spark={sorted(cols)} sql={sorted(ocols)}")
            bad += 1
            continue
        h1, l1 = digest(cols, rows)
        h2, l2 = digest(ocols, orows)
        if len(rows) != len(orows) or h1 != h2:
            bad += 1
            diff1 = sorted(set(l1) - set(l2))[:3]
            diff2 = sorted(set(l2) - set(l1))[:3]
            print(f"MISMATCH {name}: rows {len(rows)} vs {len(orows)}\n  spark-only {diff1}\n  sql-only   {diff2}")
        else:
            print(f"ok {name}: {len(rows)} rows {dt:.1f}s")
    print("bad", bad)


if __name__ == "__main__":
    main()
