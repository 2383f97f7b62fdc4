"""JSONL pair source with a reject side table.

Python's ``json.loads`` is stricter than a bare ``from_json``: it rejects
single quotes and any text after the object.  Each stripped line is wrapped
as ``[line]`` and parsed as an array of one struct with single quotes
disallowed; a line is accepted only when exactly one non-null object comes
back and the line ends in ``}``.
"""

from __future__ import annotations

import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.functions import text as T

PAIR_SCHEMA = "array<struct<query:string,document:string,rank:string>>"
_JSON_OPTS = {"allowSingleQuotes": "false", "mode": "PERMISSIVE"}


def parse_pair_lines(lines: DataFrame, col: str = "value", keep=()) -> DataFrame:
    """(keep..., line, query, document, rank, reason) for every non-blank line;
    reason is null for an accepted pair, else invalid_json / missing_query /
    missing_document."""
    s = T.strip(col)
    t = lines.select(*keep, s.alias("line")).filter(F.col("line") != "")
    parsed = F.from_json(F.concat(F.lit("["), F.col("line"), F.lit("]")), PAIR_SCHEMA, _JSON_OPTS)
    t = t.withColumn("_p", parsed)
    obj = F.get(F.col("_p"), 0)
    ok = (F.col("_p").isNotNull() & (F.size("_p") == 1) & obj.isNotNull()
          & F.col("line").endswith("}"))
    t = t.select(*keep, "line", F.when(ok, obj["query"]).alias("query"), F.when(ok, obj["document"]).alias("document"),
                 F.when(ok, obj["rank"]).alias("rank"), ok.alias("_ok"))
    reason: Column = (F.when(~F.col("_ok"), F.lit("invalid_json"))
                      .when(~T.is_truthy("query"), F.lit("missing_query"))
                      .when(~T.is_truthy("document"), F.lit("missing_document")))
    return t.withColumn("reason", reason).drop("_ok")


def _lines(spark: SparkSession, path: str, stream: bool) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    try:
        return reader.option("lineSep", "\n").text(path)
    except AnalysisException as e:
        if stream or "PATH_NOT_FOUND" not in str(e):
            raise
        warnings.warn(f"pair file {path} not found; no pairs read")
        return spark.createDataFrame([], "value string")


def pairs_from_lines(lines: DataFrame, keep=()) -> DataFrame:
    p = parse_pair_lines(lines, keep=keep)
    return p.filter(F.col("reason").isNull()).select(
        *keep, "query", F.col("document").alias("positive"), T.rank_or_default("rank").alias("rank"))


def read_pairs_jsonl(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """(query, positive, rank) from a JSONL folder or file; rank defaults to 1."""
    return pairs_from_lines(_lines(spark, path, stream))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, value) of every line, blank ones included; line_no begins at 1 in each file.

    A file may be read in several splits.  The rows of a split are consecutive in one scan partition, so
    a line's number is its distance from the first row of its split plus the lines of the file's earlier
    splits; only a table with one row per split is aggregated and joined back, no line is shuffled.
    """
    raw = _lines(spark, path, False)
    if raw.isEmpty():
        return spark.createDataFrame([], "file string, line_no bigint, value string")
    t = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"),
                   F.monotonically_increasing_id().alias("_row"), "value")
    splits = t.groupBy("file", "_block").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # splits of a file
    splits = splits.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return t.join(splits, ["file", "_block"]).select(
        "file", (F.col("_row") - F.col("_first") + F.col("_before") + 1).alias("line_no"), "value")


def read_pair_rejects(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line, reason) for every non-blank line that does not give a pair."""
    p = parse_pair_lines(numbered_lines(spark, path), keep=["file", "line_no"])
    return p.filter(F.col("reason").isNotNull()).select("file", "line_no", "line", "reason")
