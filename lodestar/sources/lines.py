"""Text-line and token-line sources with stable positions inside each file set.

Lines keep the order of their files: the position key is
(file path, split start, row index within the scan partition), numbered by
the range-partitioned ``with_positions``.  Part files written by Spark carry
their order in their names, so a folder written from a sorted DataFrame reads
back in the same order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions import text as T
from lodestar.functions.arrays import parse_ids
from lodestar.operators.order import with_positions


def _raw_lines(spark: SparkSession, paths: dict) -> DataFrame:
    parts = []
    for version, path in paths.items():
        df = (spark.read.option("lineSep", "\n").text(path)
              .select(F.lit(version).alias("version"), F.col("value").alias("line"),
                      F.col("_metadata.file_path").alias("_file"),
                      F.col("_metadata.file_block_start").alias("_block"),
                      F.monotonically_increasing_id().alias("_row")))
        parts.append(df)
    return reduce(DataFrame.unionByName, parts)


def read_lines(spark: SparkSession, paths: dict, strip: bool = True) -> DataFrame:
    """{version: path} -> (version, pos, line), lines stripped like ``line.strip()``."""
    raw = _raw_lines(spark, paths)
    pos = with_positions(raw, ["_file", "_block", "_row"], pos="pos", group_by=["version"])
    line = T.strip("line") if strip else F.col("line")
    return pos.select("version", "pos", line.alias("line"))


def read_token_lines(spark: SparkSession, paths: dict) -> DataFrame:
    """{version: path} -> (version, pos, tokens array<int>); blank lines keep their position."""
    return read_lines(spark, paths).select("version", "pos", parse_ids("line").alias("tokens"))


def union_versions(parts: dict) -> DataFrame:
    """Bag union of per-version DataFrames, tagging each row with its version."""
    tagged = [df.withColumn("version", F.lit(v)) for v, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b), tagged)


def write_lines(df: DataFrame, path: str, order_by, line: str = "line") -> None:
    """Write one text line per row in ``order_by`` order (a range-partitioned sort)."""
    df.orderBy(*order_by).select(F.col(line).alias("value")).write.mode("overwrite").option("lineSep", "\n").text(path)
