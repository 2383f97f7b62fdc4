"""Training-log statistics: token budgets, batch token counts, step windows,
improvement and best-so-far tracking."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions.text import split_words
from lodestar.operators.order import running_agg
from lodestar.session import write_bytes


def token_budget(df: DataFrame, token_line: str, budget: int, epochs: int, by: str = "version") -> DataFrame:
    """Tokens per version and in total (rollup), steps per epoch = tokens div budget,
    total steps = that x epochs, warm-up = max(1, int(0.1 x total))."""
    t = (df.rollup(by).agg(F.sum(F.size(split_words(token_line))).cast("bigint").alias("n_tokens")))
    steps = F.expr(f"n_tokens div {budget}")
    t = t.withColumn("steps_per_epoch", steps).withColumn("total_steps", steps * epochs)
    return t.withColumn("warmup_steps", F.greatest(F.lit(1), (F.lit(0.1) * F.col("total_steps")).cast("bigint")))


def batch_tokens(df: DataFrame, batch_id: str = "batch_id", mask: str = "attention_mask",
                 eos_pos: str = "eos_pos") -> DataFrame:
    """Per batch: Σ of the attention masks (training) and Σ eos_pos (distillation)."""
    s = F.aggregate(F.col(mask), F.lit(0), lambda a, b: a + b)
    return df.groupBy(batch_id).agg(F.sum(s).cast("bigint").alias("mask_tokens"),
                                    F.sum(eos_pos).cast("bigint").alias("eos_tokens"))


def step_windows(df: DataFrame, width: int = 10, run: str = "run", step: str = "step") -> DataFrame:
    """Tumbling windows of ``width`` steps per run (complete windows only):
    mean loss (the distillation log), the loss at the window's last step (the
    contrastive trainer logs that instant value), tokens, seconds, tokens/s
    (0 when no time passed) and the running token total."""
    w = F.expr(f"(`{step}` - 1) div {width}")
    agg = (df.withColumn("window_id", w).groupBy(run, "window_id").agg(
        F.count(F.lit(1)).alias("_n"), F.max(step).alias("last_step"), F.avg("loss").alias("mean_loss"),
        F.max_by("loss", step).alias("instant_loss"),
        F.sum("tokens").alias("tokens"), F.sum("dt").alias("seconds"))
        .filter(F.col("_n") == width).drop("_n"))
    agg = agg.withColumn("tokens_per_sec", F.when(F.col("seconds") > 0, F.col("tokens") / F.col("seconds"))
                         .otherwise(F.lit(0.0)))
    return running_agg(agg, ["window_id"], "tokens", group_by=[run], how="sum", out="total_tokens")


def improvement(df: DataFrame, by=("run", "task"), step: str = "step", score: str = "score") -> DataFrame:
    """Final minus initial score per group (by step)."""
    return df.groupBy(*by).agg((F.max_by(score, step) - F.min_by(score, step)).alias("improvement"))


def best_so_far(df: DataFrame, run: str = "run", step: str = "step", score: str = "score",
                initial: float = 0.0) -> DataFrame:
    """Rows that set a new best: score strictly above every earlier score of the
    run and above ``initial``; adds ``previous_best``."""
    t = running_agg(df, [step], score, group_by=[run], how="max", inclusive=False, out="_prev_max")
    prev = F.coalesce(F.greatest(F.col("_prev_max"), F.lit(initial)), F.lit(initial))
    return t.withColumn("previous_best", prev).filter(F.col(score) > F.col("previous_best")).drop("_prev_max")


def write_best_record(improvements: DataFrame, path: str, run: str = "run", step: str = "step",
                      score: str = "score") -> None:
    """Best-record sink: the last improvement of each run, (run, step, best score),
    overwriting the table (one row per run)."""
    best = improvements.groupBy(run).agg(F.max_by(F.struct(step, score), step).alias("_b"))
    best.select(run, F.col(f"_b.{step}").alias(step), F.col(f"_b.{score}").alias(f"best_{score}")) \
        .write.mode("overwrite").parquet(path)


def _newest(spark: SparkSession, path: str) -> tuple[int, str | None]:
    """Number of committed versions of a best-record table, and the folder of the newest.

    Version n is the folder that the file ``version-n`` names; whoever puts that file there has committed n.
    """
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version-*")
    names = sorted(f.getPath().toString() for f in p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p) or [])
    return len(names), f"{path}/{spark.read.text(names[-1]).first()['value']}" if names else None


def _commit(spark: SparkSession, path: str, n: int, folder: str) -> bool:
    """Make ``folder`` version n unless another writer has made one: a rename that does not replace a file."""
    jvm = spark._jvm
    write_bytes(spark, f"{path}/{folder}.name", folder.encode())
    old, new = (jvm.org.apache.hadoop.fs.Path(f"{path}/{x}") for x in (f"{folder}.name", f"version-{n:06d}"))
    conf = spark._jsc.hadoopConfiguration()
    fs = old.getFileSystem(conf)
    keep = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(
            fs.makeQualified(old), fs.makeQualified(new), keep)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def read_best_record(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest version of a best-record table; None before the first one."""
    _, newest = _newest(spark, path)
    return spark.read.parquet(newest) if newest else None


def update_best_record(df: DataFrame, path: str, run: str = "run", step: str = "step", score: str = "score",
                       initial: float = 0.0) -> None:
    """Compare new scores with the stored best of each run and write the next version of the table.

    A run's record changes only for a strictly higher score, its first step taking it.  A version is written to a
    folder of its own and committed by putting the next version's file there; a writer that finds it taken
    compares with the version that came first and tries the next, so no writer's record is lost.
    """
    spark = df.sparkSession
    best = f"best_{score}"
    new = (df.filter(F.col(score) > initial).groupBy(run)
           .agg(F.max_by(F.struct(F.col(step), F.col(score).alias(best)), F.struct(F.col(score), -F.col(step))).alias("_b"))
           .select(run, F.col(f"_b.{step}").alias(step), F.col(f"_b.{best}").alias(best)))
    while True:
        n, newest = _newest(spark, path)
        state = new
        if newest is not None:
            both = spark.read.parquet(newest).withColumn("_age", F.lit(0)).unionByName(new.withColumn("_age", F.lit(-1)))
            state = both.groupBy(run).agg(F.max_by(F.struct(step, best), F.struct(best, "_age")).alias("_b")).select(run, "_b.*")
        folder = f"state-{uuid.uuid4().hex}"
        state.write.parquet(f"{path}/{folder}")
        if _commit(spark, path, n, folder):
            return
