"""Physical-plan audit of every registered query: shuffles, broadcasts,
partial top-k limits, single-partition windows, Python stages and scans.

usage: python tools/plan_audit.py [--sf DIR] [key ...]  > PLANS.md
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def audit(plan: str) -> dict:
    lines = plan.split("\n")
    shuffles = [l for l in lines if re.search(r"\bExchange (hashpartitioning|rangepartitioning|RoundRobin)", l)]
    single = [l for l in lines if "Exchange SinglePartition" in l]
    return {
        "shuffles": len(shuffles),
        "broadcasts": sum("BroadcastExchange" in l for l in lines),
        "partial_topk": sum("WindowGroupLimit" in l and "Partial" in l for l in lines),
        "single_partition": len(single),
        "python": sum(bool(re.search(r"EvalPython|(FlatMap(Co)?GroupsIn|MapIn)(Pandas|Arrow)", l)) for l in lines),
        "scans": sum(("FileScan" in l or "Scan ExistingRDD" in l or "Scan parquet" in l) for l in lines),
        "keys": sorted({m.group(1) for l in shuffles for m in [re.search(r"partitioning\(([^,]+(?:, [^,]+)*?), \d+\)", l)] if m}),
    }


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("keys", nargs="*")
    args = ap.parse_args()
    from lodestar.plans.registry import load_all
    from lodestar.session import get_session

    spark = get_session("local[8]", shuffle_partitions=16)
    queries, oracle = load_all()
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plan_audit.py` at `{args.sf}` (plans before AQE re-planning).  "
          "Landed fixtures appear as `Scan ExistingRDD` (checkpoints); streaming and sink keys show the "
          "plan that reads their written output back.  `single-partition` counts `Exchange SinglePartition` "
          "nodes; each one sits over a table bounded by construction (offsets per partition, a capped "
          "vocabulary, per-group counts).\n")
    print("| key | shuffles | broadcasts | partial top-k | single-partition | python stages | scans | shuffle keys |")
    print("|---|---|---|---|---|---|---|---|")
    for k in args.keys or sorted(queries):
        try:
            df = queries[k](spark, args.sf)
            a = audit(df._jdf.queryExecution().executedPlan().toString())
        except Exception as e:  # noqa: BLE001
            print(f"| {k} | error: {type(e).__name__} | | | | | | |")
            continue
        keys = "; ".join(sorted({re.sub(r"#\d+L?", "", x) for x in a["keys"]}))[:160]
        print(f"| {k} | {a['shuffles']} | {a['broadcasts']} | {a['partial_topk']} | {a['single_partition']} | "
              f"{a['python']} | {a['scans']} | {keys} |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
