"""Teacher-vector data: positional alignment, dimension checks and the distillation loss."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions import arrays as AR
from lodestar.functions import vectors as V


def align(*dfs: DataFrame, on=("version", "pos")) -> DataFrame:
    """Join sources row by row on their position keys.

    Every position must be in every source: one that is missing somewhere raises an error,
    since a dropped row would shift what belongs together.
    """
    keys = list(on)
    marked = [d.withColumn(f"_has{i}", F.lit(True)) for i, d in enumerate(dfs)]
    j = reduce(lambda a, b: a.join(b, keys, "full"), marked)
    everywhere = reduce(lambda a, b: a & b, [F.col(f"_has{i}").isNotNull() for i in range(len(dfs))])
    where = F.concat_ws(" ", *[F.col(k).cast("string") for k in keys])
    first = F.when(everywhere, F.col(keys[0])).otherwise(
        F.raise_error(F.concat(F.lit("sources do not align at "), where)))
    return j.withColumn(keys[0], first).drop(*[f"_has{i}" for i in range(len(dfs))])


def check_alignment(named: dict, by: str = "version") -> DataFrame:
    """Row counts of each source per ``by`` value and whether they agree.

    Returns (version, n_<name>..., ok).  A source missing a version counts 0.
    """
    counts = None
    for name, df in named.items():
        c = df.groupBy(by).agg(F.count(F.lit(1)).alias(f"n_{name}"))
        counts = c if counts is None else counts.join(c, by, "full")
    cols = [F.coalesce(F.col(f"n_{n}"), F.lit(0)).alias(f"n_{n}") for n in named]
    out = counts.select(by, *cols)
    first = F.col(f"n_{next(iter(named))}")
    ok = reduce(lambda a, b: a & b, [F.col(f"n_{n}") == first for n in named])
    return out.withColumn("ok", ok)


def check_dimensions(pred: DataFrame, target: DataFrame, on="pos",
                     pred_col: str = "pred", target_col: str = "target") -> DataFrame:
    """(pred_dim, target_dim, n, ok) over matched samples; ok only when the dims agree."""
    j = pred.join(target, on)
    return (j.groupBy(F.size(pred_col).cast("bigint").alias("pred_dim"),
                      F.size(target_col).cast("bigint").alias("target_dim"))
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("ok", F.col("pred_dim") == F.col("target_dim")))


def distill_loss(pred: DataFrame, target: DataFrame, on="pos", group="batch_id",
                 pred_col: str = "pred", target_col: str = "target", l1_weight: float = 10.0) -> DataFrame:
    """(1 - mean cosine) + l1_weight * mean |pred - target| over all N*D elements, per group."""
    j = pred.join(target, on)
    p, t = F.col(pred_col), F.col(target_col)
    den = F.greatest(V.norm(p) * V.norm(t), F.lit(1e-8))
    rows = j.select(group, (V.dot(p, t) / den).alias("_cos"), V.l1_sum(p, t).alias("_l1"),
                    F.size(p).alias("_d"))
    return rows.groupBy(group).agg(
        ((F.lit(1.0) - F.avg("_cos")) + F.lit(float(l1_weight)) *
         (F.sum("_l1") / (F.count(F.lit(1)) * F.max("_d")))).alias("loss"))


def _spliced(prefix, ids):
    """Ids without their BOS between a role's prefix and EOS."""
    body = F.when(F.size(ids) > 1, F.slice(ids, F.lit(2), F.greatest(F.size(ids) - 1, F.lit(1))))
    return F.concat(prefix, F.coalesce(body, F.array().cast("array<int>")), F.array(F.lit(AR.EOS_ID)))


def role_tokens(ids, role, prefixes=None):
    """The variant of a token line in a role that is already drawn."""
    prefixes = prefixes or {"query": AR.QUERY_PREFIX, "document": AR.DOC_PREFIX}
    prefix = F.coalesce(*[F.when(role == r, F.array(*[F.lit(i) for i in p])) for r, p in prefixes.items()])
    return _spliced(prefix, ids)


def splice_roles(df: DataFrame, tokens: str, prefixes=None) -> DataFrame:
    """Both role variants of each token line: drop BOS, prepend the role prefix,
    append EOS; adds (role, tokens, eos_pos)."""
    prefixes = prefixes or {"query": AR.QUERY_PREFIX, "document": AR.DOC_PREFIX}
    roles = F.explode(F.array(*[F.struct(F.lit(r).alias("role"), F.array(*[F.lit(i) for i in p]).alias("prefix"))
                                for r, p in prefixes.items()]))
    t = df.select("*", roles.alias("_r"))
    t = t.withColumn("role", t["_r"]["role"]).withColumn("tokens", _spliced(t["_r"]["prefix"], F.col(tokens))).drop("_r")
    return t.withColumn("eos_pos", F.size("tokens") - 1)  # the closing EOS, which every variant ends with
