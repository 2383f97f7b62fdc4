"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

usage: python tools/oracle_check.py [--sf DIR] [key ...]

Compares row count, column names, column types (mapped) and the sorted
multiset of row values.  Prints one line per key and a summary.
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

TYPE_MAP = {"BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "INTEGER": "int",
            "BOOLEAN": "boolean", "FLOAT": "float", "TIMESTAMP": "timestamp", "DATE": "date"}


def norm_val(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (2, f"{round(v, 6):.6f}")
    if isinstance(v, (list, tuple)):
        return (3, tuple(norm_val(x) for x in v))
    if hasattr(v, "tolist"):
        return (3, tuple(norm_val(x) for x in v.tolist()))
    if isinstance(v, bool):
        return (4, str(v))
    if isinstance(v, int):
        return (2, f"{float(v):.6f}") if False else (5, str(v))
    return (6, str(v))


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("keys", nargs="*")
    ap.add_argument("--show", action="store_true")
    ap.add_argument("--plain", action="store_true", help="plain SparkSession with Spark defaults")
    args = ap.parse_args()

    import duckdb
    from lodestar.session import get_session
    from lodestar.plans.registry import load_all

    if args.plain:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = get_session("local[8]", shuffle_partitions=8)
    queries, oracle = load_all()
    con = duckdb.connect()
    for t in TABLES:
        p = f"{args.sf}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    keys = args.keys or sorted(queries)
    ok = bad = rows_only = 0
    for k in keys:
        t0 = time.time()
        try:
            df = queries[k](spark, args.sf)
            rows = [tuple(r) for r in df.collect()]
            sschema = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL  {k}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if k not in oracle:
            print(f"ROWS  {k}: {len(rows)} rows (no oracle) {ts:.1f}s cols={[c for c, _ in sschema]}")
            rows_only += 1
            continue
        try:
            cur = con.execute(oracle[k])
            orows = cur.fetchall()
            ocols = [d[0] for d in cur.description]
            otypes = [str(d[1]) for d in cur.description]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL  {k}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        problems = []
        scols = [c for c, _ in sschema]
        if sorted(scols) != sorted(ocols):
            problems.append(f"columns spark={scols} oracle={ocols}")
        else:
            smap = dict(sschema)
            for c, t in zip(ocols, otypes):
                if TYPE_MAP.get(t, t.lower()) != smap[c]:
                    problems.append(f"type {c}: spark={smap[c]} oracle={t}")
        if len(rows) != len(orows):
            problems.append(f"rows spark={len(rows)} oracle={len(orows)}")
        if not problems:
            order = sorted(range(len(scols)), key=lambda i: scols[i])
            oidx = {c: i for i, c in enumerate(ocols)}
            a = sorted(tuple(norm_val(r[i]) for i in order) for r in rows)
            b = sorted(tuple(norm_val(r[oidx[scols[i]]]) for i in order) for r in orows)
            diff = [(x, y) for x, y in zip(a, b) if x != y]
            if diff:
                problems.append(f"{len(diff)} value diffs, first: spark={diff[0][0]} oracle={diff[0][1]}")
        if problems:
            bad += 1
            print(f"FAIL  {k}: {'; '.join(problems)[:1500]}")
        else:
            ok += 1
            print(f"OK    {k}: {len(rows)} rows {ts:.1f}s")
        if args.show:
            print("   spark:", rows[:3])
    print(f"summary: ok={ok} fail={bad} rows_only={rows_only} of {len(keys)}")
    spark.stop()


if __name__ == "__main__":
    main()
