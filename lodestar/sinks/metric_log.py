"""Metric-log sink: wide step records to an append-only (run, step, metric, value) table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def to_long(df: DataFrame, metrics, run: str = "run", step: str = "step") -> DataFrame:
    """``metrics``: (name, value) pairs; a name may be a Column giving the name per row."""
    entries = [F.struct((F.lit(k) if isinstance(k, str) else k).alias("metric"),
                        (F.col(v) if isinstance(v, str) else v).cast("double").alias("value"))
               for k, v in (metrics.items() if isinstance(metrics, dict) else metrics)]
    t = df.select(run, step, F.explode(F.array(*entries)).alias("_m"))
    return t.select(run, step, "_m.metric", "_m.value")


def append_metrics(df: DataFrame, path: str, run: str = "run") -> None:
    """Append rows to the Parquet log, one folder per run.

    No shuffle on ``run``: a run may hold most of the rows, so every task
    writes its own files into each run folder it has rows for.
    """
    df.sortWithinPartitions(run).write.mode("append").partitionBy(run).parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
