"""Benchmark: run the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed to completion through the ``noop`` sink (every row is
produced, nothing is collected to the driver).  Prints ONE JSON line:
{"metric": "total_query_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
Extra per-query row counts and rows/s go to stderr.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# Headline keys first; the rest of the registry follows.
HEADLINE = ["retrieve_topk", "eval_ndcg", "loss_infonce", "loss_hard_negative", "loss_ntxent",
            "tok_vocab_join", "aug_dispatch", "shuffle_global", "batch_fixed", "pool_mean",
            "metrics_tumbling", "src_pairs_jsonl"]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [k for k in os.environ.get("BENCH_KEYS", "").split(",") if k]
    from lodestar.plans.registry import load_all
    from lodestar.session import get_session

    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    queries, _ = load_all()
    keys = only or ([k for k in HEADLINE if k in queries] + sorted(k for k in queries if k not in HEADLINE))
    # Warm-up outside the timings: JVM code paths, Python workers, file listing.
    from pyspark.sql import functions as F
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("long")
    def _plus_one(s: pd.Series) -> pd.Series:
        return s + 1

    spark.range(0, 100_000, numPartitions=int(cpus)).select(_plus_one("id").alias("x")).agg(F.sum("x")).collect()
    spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type").count().collect()
    times, failures = {}, {}
    for k in keys:
        t0 = time.time()
        try:
            df = queries[k](spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            times[k] = round(time.time() - t0, 3)
        except Exception as e:  # noqa: BLE001
            failures[k] = f"{type(e).__name__}: {str(e)[:200]}"
            print(f"bench: {k} failed: {failures[k]}", file=sys.stderr)
            continue
        print(f"bench: {k} {times[k]:.2f}s", file=sys.stderr)
    # Throughput figures comparable to the published tokens/s (counted after
    # timing, from the same query outputs; not part of the per-query times).
    from pyspark.sql import functions as F
    thr = {}
    try:
        if "tok_vocab_join" in times:
            n = queries["tok_vocab_join"](spark, sf_dir).agg(
                F.sum(F.size(F.split("tokens", " ")))).first()[0] or 0
            thr["pair_tokenize_tokens_per_sec"] = round(n / times["tok_vocab_join"], 1)
        if "arr_pad_to_batch" in times:
            n = queries["arr_pad_to_batch"](spark, sf_dir).agg(
                F.sum(F.size(F.split("input_ids", " ")))).first()[0] or 0
            thr["training_batch_tokens_per_sec"] = round(n / times["arr_pad_to_batch"], 1)
        if "batch_token_budget" in times:
            n = queries["batch_token_budget"](spark, sf_dir).agg(F.sum("n_tok")).first()[0] or 0
            thr["distill_batch_tokens_per_sec"] = round(n / times["batch_token_budget"], 1)
        if "join_in_batch_pairs" in times:
            n = queries["join_in_batch_pairs"](spark, sf_dir).count()
            thr["in_batch_pairs_per_sec"] = round(n / times["join_in_batch_pairs"], 1)
    except Exception as e:  # noqa: BLE001
        print(f"bench: throughput count failed: {e}", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_query_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus),
           "spark": spark.version, "failed": sorted(failures), "throughput": thr}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
