"""Training-batch sink: long-form batches as Parquet files in batch order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestar.session import shuffle_partitions


def write_batches(df: DataFrame, path: str, files: int | None = None, batch_id: str = "batch_id") -> None:
    """Write rows in ``files`` ranges of ``batch_id`` (the session's shuffle partitions by default).

    The number of files and folders is that of the ranges, however many batches there are; Parquet
    statistics let a reader of some batches skip the other files.
    """
    (df.repartitionByRange(files or shuffle_partitions(df.sparkSession), batch_id)
     .sortWithinPartitions(batch_id).write.mode("overwrite").parquet(path))


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
