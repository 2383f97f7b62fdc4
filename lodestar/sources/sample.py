"""Seeded random-sample source: Bernoulli(p) rounds with a per-round cap."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions.random import uniform


def sample_pairs(df: DataFrame, key: str, p: float, seed: int = 42, rounds: int = 1,
                 cap: int | None = None) -> DataFrame:
    """Rows of ``df`` drawn in ``rounds`` rounds: a row is in round r when
    ``uniform(seed + r, 'sample', key) < p``; with ``cap`` each round
    keeps at most that many rows (smallest draws first), without it all.  Adds ``round``.

    The per-round cap is a ``row_number() <= cap`` filter, which Spark plans as
    a partial limit inside each map task before the shuffle on ``round``.
    """
    t = df.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
    t = t.withColumn("round", F.col("round").cast("bigint"))
    t = t.withColumn("_u", uniform(F.lit(seed) + F.col("round"), "sample", F.col(key))).filter(F.col("_u") < p)
    if cap is None:
        return t.drop("_u")
    w = Window.partitionBy("round").orderBy("_u", key)
    return t.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= cap).drop("_rn", "_u")
