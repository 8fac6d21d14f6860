"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Compares row count, column names and an order-insensitive hash of the rows
(columns sorted by name, floats printed with repr).
"""

from __future__ import annotations

import hashlib
import json
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9) + 0.0)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    return repr(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest(), lines


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from rankfold.session import get_spark
    spark = get_spark("local[8]")
    qs, orc = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    report = {}
    for k in (keys or list(qs)):
        t0 = time.time()
        try:
            df = qs[k](spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            report[k] = {"ok": False, "error": f"spark: {type(e).__name__}: {str(e)[:400]}"}
            print(k, report[k], flush=True)
            continue
        ts = time.time() - t0
        if k not in orc:
            report[k] = {"ok": None, "rows": len(rows), "spark_s": round(ts, 2), "oracle": "none"}
            print(k, report[k], flush=True)
            continue
        try:
            res = con.execute(orc[k])
            ocols = [d[0] for d in res.description]
            orows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            report[k] = {"ok": False, "error": f"duckdb: {str(e)[:400]}"}
            print(k, report[k], flush=True)
            continue
        h1, l1 = digest(cols, rows)
        h2, l2 = digest(ocols, orows)
        ok = len(rows) == len(orows) and sorted(cols) == sorted(ocols) and h1 == h2
        rep = {"ok": ok, "rows": len(rows), "orows": len(orows), "spark_s": round(ts, 2)}
        if sorted(cols) != sorted(ocols):
            rep["cols"] = [sorted(cols), sorted(ocols)]
        if not ok and h1 != h2:
            s1, s2 = set(l1), set(l2)
            rep["only_spark"] = sorted(s1 - s2)[:3]
            rep["only_oracle"] = sorted(s2 - s1)[:3]
        report[k] = rep
        print(k, json.dumps(rep)[:1500], flush=True)
    bad = [k for k, v in report.items() if v.get("ok") is False]
    print("FAILED:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
