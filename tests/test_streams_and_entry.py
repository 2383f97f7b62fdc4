"""Streaming results equal batch results; the driver entry point runs."""

from pyspark.sql import functions as F

from lodestar.functions import text as T
from lodestar.plans import fixtures as fx
from lodestar.plans.q_sources import land_jsonl
from lodestar.session import scratch_path
from lodestar.sources.jsonl import read_pairs_jsonl
from lodestar.streaming import streams as S
from tests.conftest import SF_SMALL


def test_stream_pairs_equals_batch(spark):
    src = land_jsonl(spark, SF_SMALL)
    root = scratch_path(spark, "test-stream")
    S.stream_pairs(spark, src, f"{root}/out", f"{root}/ck")
    got = sorted(tuple(r) for r in spark.read.parquet(f"{root}/out").select("query_text", "doc_text", "rank").collect())
    b = read_pairs_jsonl(spark, src).select(T.prompt("query", F.lit("query")), T.prompt("positive", F.lit("document")), "rank")
    assert got == sorted(tuple(r) for r in b.collect())


def test_stream_best_equals_batch(spark):
    from lodestar.operators.metrics import best_so_far
    x9 = fx.metric_log(spark, SF_SMALL)
    src = scratch_path(spark, "test-x9")
    x9.write.parquet(src)
    root = scratch_path(spark, "test-best")
    S.stream_best(spark, src, f"{root}/out", f"{root}/ck", x9.schema, max_files_per_trigger=1)
    got = {r.run: (r.step, r.score) for r in S.read_latest(spark, f"{root}/out").collect()}
    last = best_so_far(x9).groupBy("run").agg(F.max_by(F.struct("step", "score"), "step").alias("b")).collect()
    assert got == {r.run: (r.b.step, r.b.score) for r in last}


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["task", "split", "metric", "k", "score"]
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_stream_metrics_equals_batch(spark):
    x9 = fx.metric_log(spark, SF_SMALL)
    src = scratch_path(spark, "test-x9m")
    x9.write.parquet(src)
    root = scratch_path(spark, "test-metrics")
    S.stream_metrics(spark, src, f"{root}/out", f"{root}/ck", x9.schema,
                     max_files_per_trigger=S.files_per_trigger(spark, src), state_partitions=4)
    got = sorted((r.run, r.window_id, r.n, round(r.mean_loss, 9), r.tokens)
                 for r in S.read_latest(spark, f"{root}/out").collect())
    b = (x9.groupBy("run", F.floor((F.col("step") - 1) / 10).cast("bigint").alias("window_id"))
         .agg(F.count(F.lit(1)).alias("n"), F.avg("loss").alias("mean_loss"), F.sum("tokens").alias("tokens")))
    assert got == sorted((r.run, r.window_id, r.n, round(r.mean_loss, 9), r.tokens) for r in b.collect())


def _pair_files(path, sizes, start=0):
    """Files of that many pairs each, a bad line in front of every one; names in order."""
    import json
    import os

    os.makedirs(path, exist_ok=True)
    at = start
    for k, n in enumerate(sizes):
        with open(f"{path}/part-{start:05d}-{k:03d}.jsonl", "w") as f:
            f.write("not json\n\n")
            for i in range(at, at + n):
                f.write(json.dumps({"query": f"q{i}", "document": f"d{i}", "rank": 1 + i % 3}) + "\n")
        at += n
    return at


def _batches(spark, out):
    return sorted((r.pos, r.batch_id, r.slot, r.query) for r in S.read_batches(spark, out).collect())


def test_stream_batches_go_on_across_triggers_and_restarts(spark, tmp_path):
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    n = _pair_files(src, [3, 9, 1, 0, 7, 21])
    S.touch_in_order(spark, src)
    S.stream_batches(spark, src, out, ck, size=8, max_files_per_trigger=1)
    want = [(i, i // 8, i % 8, f"q{i}") for i in range(n)]
    assert n % 8 and _batches(spark, out) == want
    # restart between triggers: new files join the batch left open
    n = _pair_files(src, [2, 5], start=n)
    S.stream_batches(spark, src, out, ck, size=8, max_files_per_trigger=1)
    want = [(i, i // 8, i % 8, f"q{i}") for i in range(n)]
    assert _batches(spark, out) == want


def test_stream_batches_replayed_epoch_replaces_its_rows(spark, tmp_path):
    import shutil

    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    n = _pair_files(src, [5, 6, 4])
    S.touch_in_order(spark, src)
    S.stream_batches(spark, src, out, ck, size=4, max_files_per_trigger=1)
    want = _batches(spark, out)
    # the job died after the last epoch had written its rows and before the stream committed it
    shutil.rmtree(f"{out}/epoch-000000000002/next")
    for name in ("2", ".2.crc"):
        import os
        if os.path.exists(f"{ck}/commits/{name}"):
            os.remove(f"{ck}/commits/{name}")
    assert len(_batches(spark, out)) == 11  # a reader sees the committed epochs only
    S.stream_batches(spark, src, out, ck, size=4, max_files_per_trigger=1)
    assert n == 15 and _batches(spark, out) == want


def test_windows_are_appended_once_and_late_rows_left_out(spark, tmp_path):
    import datetime as dt

    t0 = dt.datetime(2024, 1, 1)
    schema = "run long, step long, loss double, tokens long, dt double, ts timestamp"
    files = [
        [(0, 1, 1.0, 5, 0.5, 0), (1, 1, 9.0, 1, 0.0, 0), (1, 2, 7.0, 1, 0.0, 1)],   # run 1, window 0 is complete
        [(0, 3, 2.0, 1, 1.0, 100), (0, 4, 4.0, 3, 1.0, 101)],                       # window 1 of run 0; window 0 expires
        [(1, 3, 1.0, 1, 1.0, 300)],
        [(0, 2, 8.0, 1, 1.0, 1), (1, 4, 3.0, 1, 1.0, 299)],                         # the first row is late
    ]
    src = str(tmp_path / "in")
    for k, rows in enumerate(files):
        spark.createDataFrame([(*r[:5], t0 + dt.timedelta(seconds=r[5])) for r in rows], schema).coalesce(1).write.parquet(
            f"{src}/{k:02d}")
    S.touch_in_order(spark, src)
    flat = str(tmp_path / "flat")
    import os
    import shutil
    os.makedirs(flat)
    for k in range(len(files)):
        part = next(f for f in os.listdir(f"{src}/{k:02d}") if f.endswith(".parquet"))
        shutil.copy(f"{src}/{k:02d}/{part}", f"{flat}/part-{k:02d}.parquet")
    S.touch_in_order(spark, flat)
    S.stream_windows(spark, flat, str(tmp_path / "out"), str(tmp_path / "ck"), schema, width=2, delay="10 seconds",
                     max_files_per_trigger=1, state_partitions=2)
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [(0, 1, 4, 3.0, 4.0, 4, 2.0, 2.0), (1, 0, 2, 8.0, 7.0, 2, 0.0, 0.0), (1, 1, 4, 2.0, 3.0, 2, 2.0, 1.0)]
