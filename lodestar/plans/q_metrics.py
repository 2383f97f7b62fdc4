"""Metric-log queries (E15, E16, E18, F5, K3) over fixture X9."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators import metrics as M
from lodestar.plans import fixtures as fx
from lodestar.plans import oracle as o
from lodestar.plans.registry import as_long, query, r6
from lodestar.session import scratch_path
from lodestar.sinks.metric_log import append_metrics, read_metrics, to_long

WIDTH = 10

TUMBLING_SQL = o.with_ctes(o.X9) + f"""
, w AS (SELECT run, (step - 1) // {WIDTH} AS window_id, count(*) AS n, max(step) AS last_step, avg(loss) AS mean_loss,
              arg_max(loss, step) AS instant_loss, sum(tokens) AS tokens, sum(dt) AS seconds
       FROM x9 GROUP BY run, (step - 1) // {WIDTH})
SELECT run, window_id, last_step, round(mean_loss, 6) AS mean_loss, round(instant_loss, 6) AS instant_loss,
       CAST(tokens AS BIGINT) AS tokens,
       round(seconds, 6) AS seconds, round(CASE WHEN seconds > 0 THEN tokens / seconds ELSE 0.0 END, 6) AS tokens_per_sec,
       CAST(sum(tokens) OVER (PARTITION BY run ORDER BY window_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS total_tokens
FROM w WHERE n = {WIDTH}
"""


def tumbling_out(t):
    return t.select("run", "window_id", "last_step", r6("mean_loss").alias("mean_loss"),
                    r6("instant_loss").alias("instant_loss"), as_long("tokens").alias("tokens"),
                    r6("seconds").alias("seconds"), r6("tokens_per_sec").alias("tokens_per_sec"),
                    as_long("total_tokens").alias("total_tokens"))


@query("metrics_tumbling", TUMBLING_SQL)
def metrics_tumbling(spark, sf_dir):
    return tumbling_out(M.step_windows(fx.metric_log(spark, sf_dir), WIDTH))


@query("metrics_improvement", o.with_ctes(o.X9) + """
SELECT run, task, round(arg_max(score, step) - arg_min(score, step), 6) AS improvement FROM x9 GROUP BY run, task
""")
def metrics_improvement(spark, sf_dir):
    t = M.improvement(fx.metric_log(spark, sf_dir))
    return t.select("run", "task", r6("improvement").alias("improvement"))


BEST_SQL = o.with_ctes(o.X9) + """
, p AS (SELECT run, step, score, greatest(coalesce(max(score) OVER (PARTITION BY run ORDER BY step
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0), 0.0) AS previous_best FROM x9)
SELECT run, step, round(score, 6) AS score, round(previous_best, 6) AS previous_best FROM p WHERE score > previous_best
"""


@query("metrics_best_so_far", BEST_SQL)
def metrics_best_so_far(spark, sf_dir):
    t = M.best_so_far(fx.metric_log(spark, sf_dir))
    return t.select("run", "step", r6("score").alias("score"), r6("previous_best").alias("previous_best"))


@query("best_record_update", o.with_ctes(o.X9) + """
SELECT run, arg_min(step, (-score, step)) AS step, round(max(score), 6) AS best_score FROM x9 WHERE score > 0 GROUP BY run
""")
def best_record_update(spark, sf_dir):
    """Two sessions of a run: the second one reads the first one's record and replaces it where it is beaten."""
    x9 = fx.metric_log(spark, sf_dir)
    path = scratch_path(spark, "best-record")
    M.update_best_record(x9.filter(F.col("step") % 2 == 1), path)
    M.update_best_record(x9.filter(F.col("step") % 2 == 0), path)
    t = M.read_best_record(spark, path)
    return t.select("run", as_long("step").alias("step"), r6("best_score").alias("best_score"))


@query("sink_metric_log", o.with_ctes(o.X9) + """
SELECT run, step, 'train/loss' AS metric, round(loss, 6) AS value FROM x9
UNION ALL SELECT run, step, 'train/tokens', round(CAST(tokens AS DOUBLE), 6) FROM x9
UNION ALL SELECT run, step, 'train/seconds', round(dt, 6) FROM x9
UNION ALL SELECT run, step, 'eval/ndcg@5/' || task, round(score, 6) FROM x9
""")
def sink_metric_log(spark, sf_dir):
    x9 = fx.metric_log(spark, sf_dir)
    long = to_long(x9, [("train/loss", "loss"), ("train/tokens", "tokens"), ("train/seconds", "dt"),
                        (F.concat(F.lit("eval/ndcg@5/"), F.col("task")), "score")])
    path = scratch_path(spark, "metric-log")
    append_metrics(long.filter(F.col("run") < 2), path)   # two appends, as two logging sessions
    append_metrics(long.filter(F.col("run") >= 2), path)
    back = read_metrics(spark, path)
    return back.select(as_long("run").alias("run"), "step", "metric", r6("value").alias("value"))
