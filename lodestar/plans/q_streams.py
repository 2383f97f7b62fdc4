"""Streaming queries (H1, H2, H4, H5, H6): inputs landed in the shared folder,
streamed with availableNow, results read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.plans import fixtures as fx
from lodestar.plans import oracle as o
from lodestar.plans.q_sources import X1J_LINES, land_jsonl, land_jsonl_chunks
from lodestar.operators.order import running_agg
from lodestar.plans.q_metrics import TUMBLING_SQL, WIDTH, tumbling_out
from lodestar.plans.q_udf import encoder_sql
from lodestar.plans.registry import as_long, query, r6
from lodestar.session import scratch_path, shuffle_partitions
from lodestar.streaming import streams as S


def _paths(spark, name):
    root = scratch_path(spark, name)
    return f"{root}/out", f"{root}/checkpoint"


@query("stream_pairs", o.with_ctes(o.X1) + f"""
, v AS (SELECT query, document, {o.rank_default_sql('rank')} AS r FROM x1 WHERE query <> '' AND document <> ''
        UNION ALL SELECT 'q4', 'd4', 1 UNION ALL SELECT 'q6', 'd6', 2)
SELECT '<unused0>' || query || '<eos>' AS query_text, '<unused1>' || document || '<eos>' AS doc_text,
       CAST(r AS BIGINT) AS rank, round({o.rank_weight_sql('r')}, 6) AS weight FROM v
""")
def stream_pairs(spark, sf_dir):
    out, ck = _paths(spark, "stream-pairs")
    S.stream_pairs(spark, land_jsonl(spark, sf_dir), out, ck)
    t = spark.read.parquet(out)
    return t.select("query_text", "doc_text", as_long("rank").alias("rank"), r6("weight").alias("weight"))


@query("stream_batches", o.with_ctes(o.X1, X1J_LINES) + """
SELECT pos, pos // 16 AS batch_id, pos % 16 AS slot, query, positive, rank FROM (
  SELECT query, positive, rank, row_number() OVER (ORDER BY line) - 1 AS pos FROM x1j WHERE reason IS NULL AND NOT blank)
""")
def stream_batches(spark, sf_dir):
    out, ck = _paths(spark, "stream-batches")
    src = land_jsonl_chunks(spark, sf_dir)
    S.touch_in_order(spark, src)
    S.stream_batches(spark, src, out, ck, size=16, max_files_per_trigger=S.files_per_trigger(spark, src, "text"))
    return S.read_batches(spark, out).select("pos", "batch_id", "slot", "query", "positive", as_long("rank").alias("rank"))


def _land_x9(spark, sf_dir):
    path = scratch_path(spark, "x9")
    x9 = fx.metric_log(spark, sf_dir)
    x9.write.mode("overwrite").parquet(path)
    return path, x9.schema


@query("stream_best", o.with_ctes(o.X9) + """
SELECT run, step, round(score, 6) AS score FROM (
  SELECT run, step, score, row_number() OVER (PARTITION BY run ORDER BY score DESC, step) AS rn FROM x9) WHERE rn = 1
""")
def stream_best(spark, sf_dir):
    src, schema = _land_x9(spark, sf_dir)
    out, ck = _paths(spark, "stream-best")
    S.stream_best(spark, src, out, ck, schema, max_files_per_trigger=S.files_per_trigger(spark, src))
    t = S.read_latest(spark, out)
    return t.select("run", "step", r6("score").alias("score"))


@query("stream_metrics", o.with_ctes(o.X9) + """
SELECT run, (step - 1) // 10 AS window_id, count(*) AS n, round(avg(loss), 6) AS mean_loss,
       CAST(sum(tokens) AS BIGINT) AS tokens FROM x9 GROUP BY ALL
""")
def stream_metrics(spark, sf_dir):
    src, schema = _land_x9(spark, sf_dir)
    out, ck = _paths(spark, "stream-metrics")
    S.stream_metrics(spark, src, out, ck, schema, max_files_per_trigger=S.files_per_trigger(spark, src))
    t = S.read_latest(spark, out)
    return t.select("run", "window_id", "n", r6("mean_loss").alias("mean_loss"), as_long("tokens").alias("tokens"))


@query("stream_windows", TUMBLING_SQL)
def stream_windows(spark, sf_dir):
    """Metric windows appended as they complete, from a log in order of time; the running total is made on reading."""
    src = scratch_path(spark, "x9-in-time")
    x9 = fx.metric_log(spark, sf_dir, timed=True)
    x9.repartitionByRange(8, "ts", "run", "step").sortWithinPartitions("ts").write.parquet(src)
    S.touch_in_order(spark, src)
    out, ck = _paths(spark, "stream-windows")
    S.stream_windows(spark, src, out, ck, x9.schema, width=WIDTH, delay="10 days",
                     max_files_per_trigger=S.files_per_trigger(spark, src))
    t = spark.read.parquet(out)
    return tumbling_out(running_agg(t, ["window_id"], "tokens", group_by=["run"], out="total_tokens"))


@query("stream_embed", "WITH src AS (SELECT doc_id, 'document' AS role, text FROM documents),"
       + encoder_sql("src", "doc_id", "mean") + "SELECT doc_id, CAST(dim AS BIGINT) AS dim, value FROM enc")
def stream_embed(spark, sf_dir):
    src = scratch_path(spark, "docs-in")
    d = fx.table(spark, sf_dir, "documents").select("doc_id", "text")
    # the files of a trigger, a quarter of all, are one task each at least
    d.repartition(4 * shuffle_partitions(spark), "doc_id").write.mode("overwrite").parquet(src)
    out, ck = _paths(spark, "stream-embed")
    S.stream_embed(spark, src, out, ck, "doc_id long, text string", "doc_id",
                   max_files_per_trigger=S.files_per_trigger(spark, src))
    t = spark.read.parquet(out).select("doc_id", F.posexplode("embedding").alias("dim", "value"))
    return t.select("doc_id", as_long("dim").alias("dim"), r6("value").alias("value"))
