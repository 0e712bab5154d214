"""Run every registered query in Spark and its SQL twin in DuckDB; compare.

Usage: python tools/oracle_check.py [sf_dir] [name ...]
Prints one line per query: OK / MISMATCH / ROWS-ONLY and a summary.
"""

from __future__ import annotations

import json
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import duckdb  # noqa: E402

from sigmesh.plans.registry import load_all  # noqa: E402
from sigmesh.session import build_session  # noqa: E402
from sigmesh.sources.tables import TABLES  # noqa: E402


def norm_val(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(norm_val(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return v


def rows_key(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm_val(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: json.dumps(r, default=str))


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)]
    spark = build_session("local[8]", 8)
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create or replace view {t} as select * from read_parquet('{p}')")
    reg = load_all()
    ok = bad = rows_only = 0
    for name, spec in reg.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = spec.build(spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"ERROR {name}: spark {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        dt = time.time() - t0
        if not spec.sql:
            print(f"ROWS-ONLY {name}: {len(s_rows)} rows ({dt:.1f}s)")
            rows_only += 1
            continue
        try:
            res = con.execute(spec.sql)
            d_cols = [c[0] for c in res.description]
            d_rows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"ERROR {name}: duckdb {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        problems = []
        if sorted(s_cols) != sorted(d_cols):
            problems.append(f"cols spark={s_cols} duck={d_cols}")
        if len(s_rows) != len(d_rows):
            problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
        if not problems:
            a, b = rows_key(s_cols, s_rows), rows_key(d_cols, d_rows)
            if a != b:
                diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
                problems.append(f"values differ, e.g. {diff}")
        if problems:
            bad += 1
            print(f"MISMATCH {name}: " + "; ".join(problems)[:1500])
        else:
            ok += 1
            print(f"OK {name}: {len(s_rows)} rows ({dt:.1f}s)")
    print(json.dumps({"ok": ok, "bad": bad, "rows_only": rows_only}))
    spark.stop()


if __name__ == "__main__":
    main()
