"""In-batch scoring and contrastive losses over the long form of the logit matrix.

``in_batch_pairs`` builds (group, qi, di, logit) for every query x document of
the same group by an equi-join on the group key: n^2 rows per group, linear in
the data for a bounded group size, and never a global cross join.  The join
leaves the rows hash-partitioned by the group key, so every later aggregate
and window keyed by (group, qi) or (group, di) reuses that partitioning
instead of shuffling again.

Losses (per example, one row per (group, qi)):

* ``infonce``   symmetric InfoNCE: ½[(lse_row - pos) + (lse_col - pos)]
* ``hard_negative`` InfoNCE with importance-weighted negatives
  imp = (neg_exp + eps)^beta normalised to mean 1 over the row
* ``ntxent``    NT-Xent over the positive and mined negatives (eligibility by
  ``perc_pos`` / ``margin_pos``, then top-k *distinct* scores via dense_rank)

Mining compares scores as whole multiples of 1 / POINT, so scores that differ in their last bits only are
equal, on any engine and in any order of addition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions.vectors import dot_logit

EPS = 1e-8
#: Scores are compared as whole multiples of 1 / POINT.
POINT = 1_000_000


def _fixed(score):
    return F.round(score * F.lit(float(POINT))).cast("bigint")


def in_batch_pairs(df: DataFrame, q: str = "qv", d: str = "dv", group="batch_id", idx: str = "pos",
                   tau: float = 0.05, tile: int | None = None) -> DataFrame:
    """All query x document pairs inside each group: (group..., qi, di, logit = q·d/tau).

    A group of n rows yields n^2 pairs.  Batches from ``batch_fixed`` or ``micro_split`` are
    bounded, and one join on the group serves them.  For groups of any size give ``tile``:
    queries and documents of a group are then dealt into tiles of about that many
    rows and each pair of tiles is joined by itself, with the same result.
    """
    g = _g(group)
    qs = df.select(*g, F.col(idx).alias("qi"), F.col(q).alias("_q"))
    ds = df.select(*g, F.col(idx).alias("di"), F.col(d).alias("_d"))
    keys = g
    if tile is not None:
        tiles = df.groupBy(*g).agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("_n"))
        every = F.explode(F.sequence(F.lit(0), F.col("_n") - 1))
        qs = qs.join(tiles, g).withColumn("_qt", F.pmod(F.xxhash64("qi"), "_n").cast("int")).withColumn(
            "_dt", every).drop("_n")
        ds = ds.join(tiles, g).withColumn("_dt", F.pmod(F.xxhash64("di"), "_n").cast("int")).withColumn(
            "_qt", every).drop("_n")
        keys = [*g, "_qt", "_dt"]
    return qs.join(ds, keys).select(*g, "qi", "di", dot_logit("_q", "_d", tau).alias("logit"))


def _g(group):
    return [group] if isinstance(group, str) else list(group)


def _both_lse(pairs: DataFrame, g) -> DataFrame:
    """The diagonal rows (qi = di) with the log-sum-exp of their row and of their column.

    Both are windows over one frame of pairs, so the pairs are made once.
    """
    row, col = Window.partitionBy(*g, "qi"), Window.partitionBy(*g, "di")
    t = (pairs.withColumn("_mr", F.max("logit").over(row)).withColumn("_mc", F.max("logit").over(col))
         .withColumn("lse_row", F.col("_mr") + F.log(F.sum(F.exp(F.col("logit") - F.col("_mr"))).over(row)))
         .withColumn("lse_col", F.col("_mc") + F.log(F.sum(F.exp(F.col("logit") - F.col("_mc"))).over(col))))
    return t.filter(F.col("qi") == F.col("di"))


def log_sum_exp(pairs: DataFrame, group="batch_id") -> DataFrame:
    """Max-shifted log-sum-exp per row (axis 'row', idx = qi) and per column
    (axis 'col', idx = di): (group..., axis, idx, lse)."""
    g = _g(group)
    both = F.array(F.struct(F.lit("row").alias("axis"), F.col("qi").alias("idx"), F.col("lse_row").alias("lse")),
                   F.struct(F.lit("col").alias("axis"), F.col("di").alias("idx"), F.col("lse_col").alias("lse")))
    return _both_lse(pairs, g).select(*g, F.explode(both).alias("_x")).select(*g, "_x.*")


def infonce(pairs: DataFrame, group="batch_id") -> DataFrame:
    """Symmetric InfoNCE per example: (group..., qi, loss)."""
    g = _g(group)
    pos = F.col("logit")
    loss = F.lit(0.5) * ((F.col("lse_row") - pos) + (F.col("lse_col") - pos))
    return _both_lse(pairs, g).select(*g, "qi", loss.alias("loss"))


def _row_stats(pairs: DataFrame, g) -> DataFrame:
    """Attach the row max, the row's positive logit and shifted exponentials."""
    w = Window.partitionBy(*g, "qi")
    is_pos = F.col("qi") == F.col("di")
    return (pairs.withColumn("_m", F.max("logit").over(w))
            .withColumn("_pos", F.max(F.when(is_pos, F.col("logit"))).over(w))
            .withColumn("_e", F.exp(F.col("logit") - F.col("_m")))
            .withColumn("_ne", F.when(is_pos, F.lit(0.0)).otherwise(F.col("_e"))))


def importance(pairs: DataFrame, beta: float = 1.0, group="batch_id") -> DataFrame:
    """Normalised negative importance imp/(mean_imp + eps) per (group, qi, di), di != qi.

    imp = (neg_exp + eps)^beta; the row mean divides the sum over *all* columns
    (the diagonal contributes eps^beta) by the negative count n-1 (+eps).
    """
    g = _g(group)
    t = _row_stats(pairs, g).withColumn("_imp", F.pow(F.col("_ne") + F.lit(EPS), F.lit(float(beta))))
    w = Window.partitionBy(*g, "qi")
    t = t.withColumn("_mean", F.sum("_imp").over(w) / (F.count(F.lit(1)).over(w) - 1 + F.lit(EPS)))
    return (t.filter(F.col("qi") != F.col("di"))
            .select(*g, "qi", "di", (F.col("_imp") / (F.col("_mean") + F.lit(EPS))).alias("importance")))


def hard_negative(pairs: DataFrame, beta: float = 1.0, group="batch_id") -> DataFrame:
    """Hard-negative InfoNCE per example: -ln(p / (p + Σ neg_exp·imp_norm + eps))."""
    g = _g(group)
    t = _row_stats(pairs, g)
    if beta > 0:
        t = t.withColumn("_imp", F.pow(F.col("_ne") + F.lit(EPS), F.lit(float(beta))))
        agg = t.groupBy(*g, "qi").agg(
            F.max(F.exp(F.col("_pos") - F.col("_m"))).alias("_p"),
            F.sum(F.col("_ne") * F.col("_imp")).alias("_s1"),
            F.sum("_imp").alias("_si"), F.count(F.lit(1)).alias("_n"))
        mean = F.col("_si") / (F.col("_n") - 1 + F.lit(EPS))
        neg = F.col("_s1") / (mean + F.lit(EPS))
    else:
        agg = t.groupBy(*g, "qi").agg(F.max(F.exp(F.col("_pos") - F.col("_m"))).alias("_p"),
                                      F.sum("_ne").alias("_s1"))
        neg = F.col("_s1")
    loss = -F.log(F.col("_p") / (F.col("_p") + neg + F.lit(EPS)))
    return agg.select(*g, "qi", loss.alias("loss"))


def _allowed(method: str, margin: float):
    """Whether a pair is a negative that the mining rule lets through; needs _pos."""
    neg = F.col("qi") != F.col("di")
    score, pos, m = _fixed(F.col("logit")), _fixed(F.col("_pos")), F.lit(round(margin * POINT)).cast("bigint")
    if method == "perc_pos":
        return neg & (score * POINT >= pos * m)
    if method == "margin_pos":
        return neg & (score >= pos - m)
    return neg


def eligible(pairs: DataFrame, method: str = "perc_pos", margin: float = 0.95, group="batch_id") -> DataFrame:
    """Negatives allowed by the mining rule: (group..., qi, di, logit).

    perc_pos: logit >= margin * pos;  margin_pos: logit >= pos - margin;
    anything else: every negative.  Thresholds act on temperature-scaled logits.
    """
    g = _g(group)
    t = pairs.withColumn("_pos", F.max(F.when(F.col("qi") == F.col("di"), F.col("logit")))
                         .over(Window.partitionBy(*g, "qi")))
    return t.filter(_allowed(method, margin)).select(*g, "qi", "di", "logit")


def hard_negatives(cands: DataFrame, k: int | None = 4, group="batch_id") -> DataFrame:
    """Keep the negatives holding one of the k largest *distinct* scores of their row."""
    g = _g(group)
    if k is None or k <= 0:
        return cands
    w = Window.partitionBy(*g, "qi").orderBy(_fixed(F.col("logit")).desc())
    return cands.withColumn("_dr", F.dense_rank().over(w)).filter(F.col("_dr") <= k).drop("_dr")


def ntxent(pairs: DataFrame, method: str = "perc_pos", margin: float = 0.95, k: int | None = 4,
           group="batch_id") -> DataFrame:
    """NT-Xent with mined negatives: -ln(p / (p + Σ_selected exp(l - max) + eps))."""
    g = _g(group)
    # one frame: a pair that the rule does not let through ranks last, after all that it does
    t = _row_stats(pairs, g).withColumn("_cand", F.when(_allowed(method, margin), _fixed(F.col("logit"))))
    chosen = F.col("_cand").isNotNull()
    if k is not None and k > 0:
        w = Window.partitionBy(*g, "qi").orderBy(F.col("_cand").desc_nulls_last())
        t = t.withColumn("_dr", F.dense_rank().over(w))
        chosen = chosen & (F.col("_dr") <= k)
    agg = t.groupBy(*g, "qi").agg(
        F.max(F.exp(F.col("_pos") - F.col("_m"))).alias("_p"),
        F.coalesce(F.sum(F.when(chosen, F.col("_e"))), F.lit(0.0)).alias("_neg"))
    loss = -F.log(F.col("_p") / (F.col("_p") + F.col("_neg") + F.lit(EPS)))
    return agg.select(*g, "qi", loss.alias("loss"))


def contrastive_loss(pairs: DataFrame, kind: str = "nce", group="batch_id", **params) -> DataFrame:
    """Dispatch by loss name: 'nce' | 'hn' | 'ntx' (the trainer's --loss choice)."""
    if kind == "nce":
        return infonce(pairs, group)
    if kind == "hn":
        return hard_negative(pairs, params.get("beta", 1.0), group)
    if kind == "ntx":
        return ntxent(pairs, params.get("mining_method", "perc_pos"), params.get("mining_margin", 0.95),
                      params.get("num_hard_negatives", 4), group)
    raise ValueError(f"unknown loss {kind}")


def reduce_loss(per_example: DataFrame, group="batch_id", weights: DataFrame | None = None,
                on=("batch_id", "qi")) -> DataFrame:
    """Per group: weighted mean Σ(l·w)/(Σw + 1e-8) (when weights are given) and plain mean."""
    g = _g(group)
    t = per_example
    aggs = [F.avg("loss").alias("mean_loss")]
    if weights is not None:
        t = t.join(weights, list(on))
        aggs.insert(0, (F.sum(F.col("loss") * F.col("weight")) / (F.sum("weight") + F.lit(EPS))).alias("weighted_loss"))
    return t.groupBy(*g).agg(*aggs)


def step_loss(micro_losses: DataFrame, g: int, batch_id: str = "batch_id") -> DataFrame:
    """Step loss = Σ micro-batch losses / g (unweighted mean of the g micro losses)."""
    return micro_losses.groupBy(batch_id).agg((F.sum("loss") / F.lit(float(g))).alias("step_loss"))
