"""Batching queries (C2, C3, C4) over fixtures X1 and X8."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.functions import arrays as AR
from lodestar.operators import augment as A
from lodestar.operators import order as OR
from lodestar.operators import tokens as TK
from lodestar.operators.teacher import role_tokens
from lodestar.operators.pairs import valid_pairs
from lodestar.plans import fixtures as fx
from lodestar.plans import oracle as o
from lodestar.plans.q_tokens import VOCAB, X8
from lodestar.plans.registry import as_long, query

B, EPOCHS = 16, 3
BUDGET, BUFFER = 256, 1000

_VALID = """
xv AS (SELECT pair_id, row_number() OVER (ORDER BY pair_id) - 1 AS pos FROM x1 WHERE query <> '' AND document <> '')
"""


def positioned_pairs(spark, sf_dir):
    x1 = valid_pairs(fx.raw_pairs(spark, sf_dir).withColumnRenamed("document", "positive"))
    return OR.with_positions(x1.select("pair_id"), ["pair_id"], pos="pos")


@query("batch_fixed", o.with_ctes(o.X1, _VALID) + f"""
SELECT pair_id, pos, pos // {B} AS batch_id, pos % {B} AS slot FROM xv
""")
def batch_fixed(spark, sf_dir):
    t = OR.batch_fixed(positioned_pairs(spark, sf_dir), "pos", B)
    return t.select("pair_id", "pos", "batch_id", "slot")


@query("batch_epochs", o.with_ctes(o.X1, _VALID) + f"""
SELECT e.epoch, pair_id, e.epoch * n + pos AS gpos, (e.epoch * n + pos) // {B} AS batch_id, (e.epoch * n + pos) % {B} AS slot
FROM (SELECT *, count(*) OVER () AS n FROM xv) CROSS JOIN (SELECT range AS epoch FROM range({EPOCHS})) e
""")
def batch_epochs(spark, sf_dir):
    t = OR.batch_epochs(positioned_pairs(spark, sf_dir), "pos", B, EPOCHS)
    return t.select("epoch", "pair_id", "gpos", "batch_id", "slot")


@query("batch_epochs_reshuffle", o.with_ctes(o.X1, _VALID) + f"""
SELECT epoch, pair_id, epoch * n + p AS gpos, (epoch * n + p) // {B} AS batch_id, (epoch * n + p) % {B} AS slot
FROM (SELECT *, row_number() OVER (PARTITION BY epoch ORDER BY k, pair_id) - 1 AS p FROM (
  SELECT e.epoch, pair_id, n, {o.hash_sql(42, 'epoch', 'e.epoch', 'pair_id')} AS k
  FROM (SELECT *, count(*) OVER () AS n FROM xv) CROSS JOIN (SELECT range AS epoch FROM range({EPOCHS})) e))
""")
def batch_epochs_reshuffle(spark, sf_dir):
    """Every epoch in an order of its own, as a fresh stream per epoch gives."""
    t = OR.batch_epochs(positioned_pairs(spark, sf_dir), "pos", B, EPOCHS, reshuffle_key="pair_id")
    return t.select("epoch", "pair_id", "gpos", "batch_id", "slot")


def distill_samples(spark, sf_dir):
    """Distillation samples in shuffled order: the role of a token line is drawn first, and only the line's ids are
    shuffled; ``tokens`` are spliced afterwards."""
    from lodestar.plans.q_tokens import x8
    t = x8(spark, sf_dir).select(
        F.concat_ws(":", "version", F.col("pos").cast("string")).alias("line_id"),
        A.assign_role(42, F.col("version"), F.col("pos")).alias("role"), AR.parse_ids("token_line").alias("ids"))
    return OR.shuffle(t, "line_id", 42, pos="spos").withColumn("tokens", role_tokens(F.col("ids"), F.col("role")))


_PACK_SQL = o.with_ctes(o.X3, VOCAB, X8).replace("WITH ", "WITH RECURSIVE ", 1) + f"""
, pk_l AS (
  SELECT version || ':' || pos AS line_id, CASE WHEN {o.u_sql(42, 'role', 'version', 'pos')} < 0.5 THEN 'query' ELSE 'document' END AS role,
         greatest(len(list_filter(string_split(token_line, ' '), lambda x: x <> '')) - 1, 0) + 3 AS n_tok FROM x8),
pk_s AS (SELECT *, row_number() OVER (ORDER BY {o.hash_sql(42, 'shuffle', 'line_id')}, line_id) - 1 AS spos FROM pk_l),
pk_b AS (SELECT *, spos // {BUFFER} AS buffer_id,
                row_number() OVER (PARTITION BY spos // {BUFFER} ORDER BY n_tok, spos) AS rn FROM pk_s),
pk_r AS (
  SELECT buffer_id, rn, spos, 0 AS cur, 1 AS cnt, n_tok AS mx FROM pk_b WHERE rn = 1
  UNION ALL
  SELECT b.buffer_id, b.rn, b.spos, CASE WHEN (r.cnt + 1) * greatest(r.mx, b.n_tok) > {BUDGET} THEN r.cur + 1 ELSE r.cur END,
         CASE WHEN (r.cnt + 1) * greatest(r.mx, b.n_tok) > {BUDGET} THEN 1 ELSE r.cnt + 1 END,
         CASE WHEN (r.cnt + 1) * greatest(r.mx, b.n_tok) > {BUDGET} THEN b.n_tok ELSE greatest(r.mx, b.n_tok) END
  FROM pk_r r JOIN pk_b b ON b.buffer_id = r.buffer_id AND b.rn = r.rn + 1)
SELECT line_id, role, b.spos, CAST(n_tok AS BIGINT) AS n_tok, b.buffer_id, b.buffer_id || '-' || cur AS batch_id,
       md5('42|pack|' || b.buffer_id || '|' || cur) AS batch_key
FROM pk_b b JOIN pk_r r ON r.buffer_id = b.buffer_id AND r.rn = b.rn
"""


@query("batch_token_budget", _PACK_SQL)
def batch_token_budget(spark, sf_dir):
    s = distill_samples(spark, sf_dir).withColumn("n_tok", F.size("tokens"))
    t = TK.pack_token_budget(s, "spos", "n_tok", BUDGET, BUFFER)
    return t.select("line_id", "role", "spos", as_long("n_tok").alias("n_tok"), "buffer_id", "batch_id", "batch_key")
