"""Distillation-sample sink: committed versions with a manifest that readers check.

A version is a folder of its own: ``data`` (Parquet) and ``manifest`` (one row per data file
with its number of rows), the latter being written last; a version without a complete
manifest does not exist for a reader.  Version names begin with the time of writing, and a writer
never touches another's folder.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _counts(data: DataFrame) -> DataFrame:
    return data.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("rows"))


def write_samples(samples: DataFrame | Iterable[DataFrame], path: str) -> str:
    """Write a version; returns its folder.  Several DataFrames of one schema are its parts, each written
    before the next one is asked for."""
    version = f"{path}/version-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    for part in [samples] if isinstance(samples, DataFrame) else samples:
        part.write.mode("append").option("compression", "zstd").parquet(f"{version}/data")
    data = part.sparkSession.read.schema(part.schema).parquet(f"{version}/data")
    _counts(data).coalesce(1).write.parquet(f"{version}/manifest")
    return version


def latest_version(spark: SparkSession, path: str) -> str | None:
    """The newest committed version."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version-*/manifest/_SUCCESS")
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p) or []
    return max((f.getPath().getParent().getParent().toString() for f in found), default=None)


def read_samples(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The newest committed version, once every file of its manifest is there with its number of rows."""
    version = latest_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no committed samples below {path}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    data = reader.parquet(f"{version}/data")
    said = spark.read.schema("file string, rows bigint").parquet(f"{version}/manifest")
    wrong = (_counts(data).join(said.withColumnRenamed("rows", "said"), "file", "full")
             .filter(~F.col("rows").eqNullSafe(F.col("said"))).orderBy("file").first())
    if wrong is not None:
        raise ValueError(f"{version}: {wrong['file']} has {wrong['rows']} rows, its manifest says {wrong['said']}")
    return data
