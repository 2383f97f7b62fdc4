"""The corpus pipeline: language ID, near duplicates, decontamination, secrets, tokenizer round trip.

``run(spark, sf_dir)`` applies STAGES to ``documents`` in turn.  Every stage's
result is written as Parquet and read again before the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestar.llm import stages
from lodestar.llm.common import read_table
from lodestar.session import scratch_path, ship_package

STAGES = stages.STAGES

#: SQL cannot train the language model of the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
