"""In-batch scoring and loss queries (D3, D4, E3-E8, E14, E17, F1-F3) over fixture X5."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.functions import vectors as V
from lodestar.operators import contrastive as C
from lodestar.operators import teacher as D
from lodestar.operators.order import micro_split
from lodestar.plans import fixtures as fx
from lodestar.plans import oracle as o
from lodestar.plans.registry import as_long, query, r6

# Loss defaults of the three trainer losses.
TAU_NCE, TAU_HN, TAU_NTX = 0.05, 0.1, 0.1
BETA, MARGIN, K_NEG = 1.0, 0.95, 4
MICRO_G = 3


def _pairs_cte(tau: float, name: str = "pairs", src: str = "x5", group: str = "batch_id") -> str:
    return f"""
{name} AS (SELECT {', '.join('a.' + g.strip() for g in group.split(','))}, a.pos AS qi, b.pos AS di,
                  {o.dot_sql('a.qv', 'b.dv')} / {tau}::DOUBLE AS logit
           FROM {src} a JOIN {src} b ON {' AND '.join(f'a.{g.strip()} = b.{g.strip()}' for g in group.split(','))})
"""


def _rs_cte(src: str = "pairs", group: str = "batch_id") -> str:
    return f"""
rs AS (SELECT *, exp(logit - m) AS e, CASE WHEN qi = di THEN 0.0::DOUBLE ELSE exp(logit - m) END AS ne
       FROM (SELECT *, max(logit) OVER w AS m, max(CASE WHEN qi = di THEN logit END) OVER w AS pos
             FROM {src} WINDOW w AS (PARTITION BY {group}, qi)))
"""


def _lse_cte(src: str = "pairs", group: str = "batch_id") -> str:
    return f"""
lse AS (
  SELECT {group}, 'row' AS axis, qi AS idx, max(m) + ln(sum(exp(logit - m))) AS lse
  FROM (SELECT *, max(logit) OVER (PARTITION BY {group}, qi) AS m FROM {src}) GROUP BY {group}, qi
  UNION ALL
  SELECT {group}, 'col' AS axis, di AS idx, max(m) + ln(sum(exp(logit - m))) AS lse
  FROM (SELECT *, max(logit) OVER (PARTITION BY {group}, di) AS m FROM {src}) GROUP BY {group}, di)
"""


def _nce_cte(src: str = "pairs", group: str = "batch_id") -> str:
    gs = [g.strip() for g in group.split(",")]
    on_r = " AND ".join(f"r.{g} = p.{g}" for g in gs)
    on_c = " AND ".join(f"c.{g} = p.{g}" for g in gs)
    return _lse_cte(src, group) + f""",
nce AS (SELECT {', '.join('p.' + g for g in gs)}, p.qi,
               0.5 * ((r.lse - p.logit) + (c.lse - p.logit)) AS loss
        FROM {src} p JOIN lse r ON {on_r} AND r.axis = 'row' AND r.idx = p.qi
                     JOIN lse c ON {on_c} AND c.axis = 'col' AND c.idx = p.qi
        WHERE p.qi = p.di)
"""


def _pairs(spark, sf_dir, tau):
    return C.in_batch_pairs(fx.vector_batches(spark, sf_dir), tau=tau)


@query("join_in_batch_pairs", o.with_ctes(o.X5_BATCHES, _pairs_cte(TAU_NCE)) + """
SELECT batch_id, qi, di, round(logit, 6) AS logit FROM pairs
""")
def join_in_batch_pairs(spark, sf_dir):
    p = _pairs(spark, sf_dir, TAU_NCE)
    return p.select("batch_id", "qi", "di", r6("logit").alias("logit"))


@query("agg_lse", o.with_ctes(o.X5_BATCHES, _pairs_cte(TAU_NCE), _lse_cte()) + """
SELECT batch_id, axis, idx, round(lse, 6) AS lse FROM lse
""")
def agg_lse(spark, sf_dir):
    t = C.log_sum_exp(_pairs(spark, sf_dir, TAU_NCE))
    return t.select("batch_id", "axis", "idx", r6("lse").alias("lse"))


@query("loss_infonce", o.with_ctes(o.X5_BATCHES, _pairs_cte(TAU_NCE), _nce_cte()) + """
SELECT batch_id, qi, round(loss, 6) AS loss FROM nce
""")
def loss_infonce(spark, sf_dir):
    t = C.contrastive_loss(_pairs(spark, sf_dir, TAU_NCE), "nce")
    return t.select("batch_id", "qi", r6("loss").alias("loss"))


@query("loss_hard_negative", o.with_ctes(o.X5_BATCHES, _pairs_cte(TAU_HN), _rs_cte()) + f"""
, hn AS (SELECT batch_id, qi, max(exp(pos - m)) AS p, sum(ne * pow(ne + 1e-8, {BETA})) AS s1,
               sum(pow(ne + 1e-8, {BETA})) AS si, count(*) AS n FROM rs GROUP BY batch_id, qi)
SELECT batch_id, qi, round(-ln(p / (p + s1 / (si / (n - 1 + 1e-8) + 1e-8) + 1e-8)), 6) AS loss FROM hn
""")
def loss_hard_negative(spark, sf_dir):
    t = C.contrastive_loss(_pairs(spark, sf_dir, TAU_HN), "hn", beta=BETA)
    return t.select("batch_id", "qi", r6("loss").alias("loss"))


@query("mine_importance", o.with_ctes(o.X5_BATCHES, _pairs_cte(TAU_HN), _rs_cte()) + f"""
, imp AS (SELECT *, pow(ne + 1e-8, {BETA}) AS imp FROM rs),
mi AS (SELECT *, sum(imp) OVER w / (count(*) OVER w - 1 + 1e-8) AS mean_imp FROM imp
       WINDOW w AS (PARTITION BY batch_id, qi))
SELECT batch_id, qi, di, round(imp / (mean_imp + 1e-8), 6) AS importance FROM mi WHERE qi <> di
""")
def mine_importance(spark, sf_dir):
    t = C.importance(_pairs(spark, sf_dir, TAU_HN), beta=BETA)
    return t.select("batch_id", "qi", "di", r6("importance").alias("importance"))


_ELIG = f"""
, elig AS (SELECT batch_id, qi, di, logit, round(logit * 1e6)::BIGINT AS fixed FROM rs
         WHERE qi <> di AND round(logit * 1e6)::BIGINT * 1000000 >= round(pos * 1e6)::BIGINT * {round(MARGIN * 1_000_000)}),
sel AS (SELECT batch_id, qi, di, logit FROM (
          SELECT *, dense_rank() OVER (PARTITION BY batch_id, qi ORDER BY fixed DESC) AS dr FROM elig)
        WHERE dr <= {K_NEG})
"""


@query("mine_eligible", o.with_ctes(o.X5_BATCHES, _pairs_cte(TAU_NTX), _rs_cte()) + _ELIG + """
SELECT batch_id, qi, di FROM elig
""")
def mine_eligible(spark, sf_dir):
    t = C.eligible(_pairs(spark, sf_dir, TAU_NTX), "perc_pos", MARGIN)
    return t.select("batch_id", "qi", "di")


@query("mine_hard_negatives", o.with_ctes(o.X5_BATCHES, _pairs_cte(TAU_NTX), _rs_cte()) + _ELIG + """
SELECT batch_id, qi, di, round(logit, 6) AS logit FROM sel
""")
def mine_hard_negatives(spark, sf_dir):
    p = _pairs(spark, sf_dir, TAU_NTX)
    t = C.hard_negatives(C.eligible(p, "perc_pos", MARGIN), K_NEG)
    return t.select("batch_id", "qi", "di", r6("logit").alias("logit"))


@query("loss_ntxent", o.with_ctes(o.X5_BATCHES, _pairs_cte(TAU_NTX), _rs_cte()) + _ELIG + """
, nt AS (SELECT r.batch_id, r.qi, max(exp(r.pos - r.m)) AS p,
                coalesce(sum(CASE WHEN s.di IS NOT NULL THEN r.e END), 0.0) AS neg
         FROM rs r LEFT JOIN sel s ON s.batch_id = r.batch_id AND s.qi = r.qi AND s.di = r.di
         GROUP BY r.batch_id, r.qi)
SELECT batch_id, qi, round(-ln(p / (p + neg + 1e-8)), 6) AS loss FROM nt
""")
def loss_ntxent(spark, sf_dir):
    t = C.contrastive_loss(_pairs(spark, sf_dir, TAU_NTX), "ntx", mining_method="perc_pos",
                           mining_margin=MARGIN, num_hard_negatives=K_NEG)
    return t.select("batch_id", "qi", r6("loss").alias("loss"))


@query("reduce_weighted_loss", o.with_ctes(o.X5_BATCHES, _pairs_cte(TAU_NCE), _nce_cte()) + """
SELECT n.batch_id, round(sum(n.loss * x.weight) / (sum(x.weight) + 1e-8), 6) AS weighted_loss,
       round(avg(n.loss), 6) AS mean_loss
FROM nce n JOIN x5 x ON x.batch_id = n.batch_id AND x.pos = n.qi GROUP BY n.batch_id
""")
def reduce_weighted_loss(spark, sf_dir):
    x5 = fx.vector_batches(spark, sf_dir)
    per = C.infonce(C.in_batch_pairs(x5, tau=TAU_NCE))
    w = x5.select("batch_id", F.col("pos").alias("qi"), "weight")
    t = C.reduce_loss(per, weights=w)
    return t.select("batch_id", r6("weighted_loss").alias("weighted_loss"), r6("mean_loss").alias("mean_loss"))


_MICRO = f"""
xm AS (SELECT * FROM (
         SELECT *, (pos - batch_id * {fx.X5_BATCH}) // (count(*) OVER (PARTITION BY batch_id) // {MICRO_G}) AS micro_id,
                count(*) OVER (PARTITION BY batch_id) // {MICRO_G} AS m
         FROM x5) WHERE m > 0 AND micro_id < {MICRO_G})
"""


@query("batch_micro_split", o.with_ctes(o.X5_BATCHES, _MICRO) + """
SELECT pos, batch_id, CAST(micro_id AS BIGINT) AS micro_id FROM xm
""")
def batch_micro_split(spark, sf_dir):
    x5 = fx.vector_batches(spark, sf_dir).withColumn("slot", F.col("pos") - F.col("batch_id") * fx.X5_BATCH)
    t = micro_split(x5, MICRO_G)
    return t.select("pos", "batch_id", as_long("micro_id").alias("micro_id"))


@query("reduce_step_loss", o.with_ctes(o.X5_BATCHES, _MICRO, _pairs_cte(TAU_NCE, src="xm", group="batch_id, micro_id"),
                                       _nce_cte(group="batch_id, micro_id")) + f"""
SELECT batch_id, round(sum(loss) / {MICRO_G}.0, 6) AS step_loss FROM (
  SELECT batch_id, micro_id, avg(loss) AS loss FROM nce GROUP BY batch_id, micro_id) GROUP BY batch_id
""")
def reduce_step_loss(spark, sf_dir):
    x5 = fx.vector_batches(spark, sf_dir).withColumn("slot", F.col("pos") - F.col("batch_id") * fx.X5_BATCH)
    xm = micro_split(x5, MICRO_G)
    g = ["batch_id", "micro_id"]
    per = C.infonce(C.in_batch_pairs(xm, group=g, tau=TAU_NCE), group=g)
    micro = C.reduce_loss(per, group=g).withColumnRenamed("mean_loss", "loss")
    t = C.step_loss(micro, MICRO_G)
    return t.select("batch_id", r6("step_loss").alias("step_loss"))


@query("loss_distill", o.with_ctes(o.X5_BATCHES) + f"""
SELECT batch_id, round((1.0 - avg(cos)) + 10.0 * (sum(l1) / (count(*) * max(d))), 6) AS loss FROM (
  SELECT batch_id, {o.dot_sql('qv', 'dv')} / greatest({o.norm_sql('qv')} * {o.norm_sql('dv')}, 1e-8) AS cos,
         list_reduce(list_transform(generate_series(1, len(qv)), lambda i: abs(qv[i]::DOUBLE - dv[i]::DOUBLE)),
                     lambda s, x: s + x, 0.0::DOUBLE) AS l1,
         len(qv) AS d
  FROM x5) GROUP BY batch_id
""")
def loss_distill(spark, sf_dir):
    x5 = fx.vector_batches(spark, sf_dir)
    pred = x5.select("batch_id", "pos", F.col("qv").alias("pred"))
    target = x5.select("pos", F.col("dv").alias("target"))
    t = D.distill_loss(pred, target, on="pos", group="batch_id")
    return t.select("batch_id", r6("loss").alias("loss"))


@query("check_dimensions", o.with_ctes(o.X5_BATCHES) + """
SELECT 'full' AS check_name, CAST(len(list_slice(qv, 1, 64)) AS BIGINT) AS pred_dim, CAST(len(dv) AS BIGINT) AS target_dim,
       count(*) AS n, len(list_slice(qv, 1, 64)) = len(dv) AS ok FROM x5 GROUP BY ALL
UNION ALL
SELECT 'truncated', CAST(len(qv) AS BIGINT), CAST(len(list_slice(dv, 1, 32)) AS BIGINT), count(*),
       len(qv) = len(list_slice(dv, 1, 32)) FROM x5 GROUP BY ALL
""")
def check_dimensions(spark, sf_dir):
    x5 = fx.vector_batches(spark, sf_dir)
    full = D.check_dimensions(x5.select("pos", V.truncate_dims("qv", 64).alias("pred")),
                              x5.select("pos", F.col("dv").alias("target")), on="pos")
    cut = D.check_dimensions(x5.select("pos", F.col("qv").alias("pred")),
                             x5.select("pos", V.truncate_dims("dv", 32).alias("target")), on="pos")
    return (full.select(F.lit("full").alias("check_name"), "*")
            .unionByName(cut.select(F.lit("truncated").alias("check_name"), "*")))
