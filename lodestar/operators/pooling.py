"""Pooling of token hidden states into one vector per sequence.

Input is the long form (id, tok_pos, hidden array, mask) — one row per token.
Sums run per (sequence, dimension) with map-side partial sums, so a sequence of
any length is never gathered; only its dimensions are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.vectors import l2_normalize


def pool_mean(df: DataFrame, id: str = "id", tok_pos: str = "tok_pos", hidden: str = "hidden",
              mask: str = "mask", normalize: bool = False, out: str = "embedding") -> DataFrame:
    """Masked mean Σ h·m / max(Σ m, 1); an all-zero mask gives the zero vector."""
    t = df.select(id, F.col(mask).cast("double").alias("_m"),
                  F.posexplode(F.col(hidden).cast("array<double>")).alias("_d", "_x"))
    sums = t.groupBy(id, "_d").agg(F.sum(F.col("_x") * F.col("_m")).alias("_s"), F.sum("_m").alias("_n"))
    value = F.col("_s") / F.greatest(F.col("_n"), F.lit(1.0))
    g = sums.groupBy(id).agg(F.array_sort(F.collect_list(F.struct("_d", value.alias("v")))).alias("_v"))
    vec = F.transform("_v", lambda x: x["v"])
    if normalize:
        vec = l2_normalize(vec)
    return g.select(id, vec.alias(out))


def pool_eos(df: DataFrame, id: str = "id", tok_pos: str = "tok_pos", hidden: str = "hidden",
             eos_pos: str = "eos_pos", normalize: bool = True, out: str = "embedding") -> DataFrame:
    """Hidden state at the sequence's last-EOS position (a filter, no shuffle), then L2-normalised."""
    t = df.filter(F.col(tok_pos) == F.col(eos_pos))
    v = F.col(hidden).cast("array<double>")
    return t.select(id, (l2_normalize(v) if normalize else v).alias(out))
