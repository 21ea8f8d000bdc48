"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

    python tools/oracle_check.py [--sf /root/testdata/sf0.01] [key ...]

Comparison mirrors the driver: same column names, same row count, and the same
multiset of rows after sorting columns by name (floats already rounded).
"""

from __future__ import annotations

import argparse
import json
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        r = round(v, 6)
        return 0.0 if r == 0 else r
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(records, cols):
    out = []
    for r in records:
        out.append(tuple(_norm(r[c]) for c in cols))
    return sorted(out, key=lambda t: repr(t))


def compare(spark_rows, spark_cols, duck_rows, duck_cols):
    if sorted(spark_cols) != sorted(duck_cols):
        return False, f"columns differ: spark={sorted(spark_cols)} duck={sorted(duck_cols)}"
    cols = sorted(spark_cols)
    a = rows_of(spark_rows, cols)
    b = rows_of(duck_rows, cols)
    if len(a) != len(b):
        return False, f"row count spark={len(a)} duck={len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return False, f"first diff: spark={x} duck={y} cols={cols}"
    return True, f"{len(a)} rows"


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--json", default=None)
    ap.add_argument("keys", nargs="*")
    args = ap.parse_args()

    from cinelake.plans.registry import load_all
    from cinelake.session import build_session
    reg = load_all()
    spark = build_session()
    con = duck(args.sf)
    keys = args.keys or list(reg)
    results = {}
    for k in keys:
        e = reg[k]
        t0 = time.time()
        try:
            df = e.spark(spark, args.sf)
            srows = [r.asDict(recursive=True) for r in df.collect()]
            scols = df.columns
            ts = time.time() - t0
        except Exception as ex:  # noqa: BLE001
            results[k] = {"ok": False, "msg": f"spark error: {str(ex)[:400]}"}
            print(f"FAIL {k}: spark error {str(ex)[:400]}", flush=True)
            continue
        if e.sql is None:
            results[k] = {"ok": None, "msg": f"no oracle; {len(srows)} rows", "spark_s": ts}
            print(f"NOORACLE {k}: {len(srows)} rows spark {ts:.1f}s", flush=True)
            continue
        t1 = time.time()
        try:
            cur = con.execute(e.oracle())
            dcols = [d[0] for d in cur.description]
            drows = [dict(zip(dcols, r)) for r in cur.fetchall()]
        except Exception as ex:  # noqa: BLE001
            results[k] = {"ok": False, "msg": f"duck error: {str(ex)[:400]}"}
            print(f"FAIL {k}: duck error {str(ex)[:600]}", flush=True)
            continue
        td = time.time() - t1
        ok, msg = compare(srows, scols, drows, dcols)
        results[k] = {"ok": ok, "msg": msg, "spark_s": round(ts, 2), "duck_s": round(td, 2)}
        print(f"{'OK  ' if ok else 'FAIL'} {k}: {msg} (spark {ts:.1f}s duck {td:.1f}s)", flush=True)
    n_ok = sum(1 for r in results.values() if r["ok"])
    n_fail = sum(1 for r in results.values() if r["ok"] is False)
    print(f"SUMMARY ok={n_ok} fail={n_fail} nooracle={len(results) - n_ok - n_fail}")
    if args.json:
        with open(args.json, "w") as f:
            json.dump(results, f, indent=1)
    spark.stop()
    return 0 if n_fail == 0 else 1


if __name__ == "__main__":
    sys.exit(main())
