"""Vector column-function queries (B17-B22) over fixture X5."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.functions import vectors as V
from lodestar.plans import fixtures as fx
from lodestar.plans import oracle as o
from lodestar.plans.registry import as_long, query, r6


def _long_form(df, vec_col):
    t = df.select("pos", F.posexplode(vec_col).alias("dim", "value"))
    return t.select("pos", as_long("dim").alias("dim"), r6("value").alias("value"))


def _long_sql(expr: str) -> str:
    return f"""
SELECT pos, CAST(dim AS BIGINT) AS dim, round(value, 6) AS value FROM (
  SELECT pos, generate_subscripts(v, 1) - 1 AS dim, unnest(v) AS value FROM (SELECT pos, {expr} AS v FROM x5))
"""


# The sum of a query and a document vector is not unit-norm, so normalising it is not a no-op.
_SUM = "list_transform(generate_series(1, len(qv)), lambda i: qv[i]::DOUBLE + dv[i]::DOUBLE)"
_X5S = "x5s AS (SELECT pos, " + _SUM + " AS sv FROM x5)"
_NORM = f"list_transform(sv, lambda x: x / {o.norm_sql('sv')})"
TRUNC_DIMS = 32


def _summed(spark, sf_dir):
    x = fx.vector_pairs(spark, sf_dir)
    return x.select("pos", F.zip_with(V.to_double("qv"), V.to_double("dv"), lambda a, b: a + b).alias("sv"))


@query("vec_truncate", o.with_ctes(o.X5) + _long_sql(f"CAST(list_slice(qv, 1, {TRUNC_DIMS}) AS DOUBLE[])"))
def vec_truncate(spark, sf_dir):
    return _long_form(fx.vector_pairs(spark, sf_dir), V.truncate_dims("qv", TRUNC_DIMS))


@query("vec_l2_normalize", o.with_ctes(o.X5, _X5S) + _long_sql(_NORM).replace("FROM x5))", "FROM x5s))"))
def vec_l2_normalize(spark, sf_dir):
    return _long_form(_summed(spark, sf_dir), V.l2_normalize("sv"))


@query("vec_cast", o.with_ctes(o.X5, _X5S) + _long_sql(f"CAST(CAST({_NORM} AS FLOAT[]) AS DOUBLE[])").replace("FROM x5))", "FROM x5s))"))
def vec_cast(spark, sf_dir):
    return _long_form(_summed(spark, sf_dir), V.to_float(V.l2_normalize("sv")))


@query("vec_dot_logit", o.with_ctes(o.X5) + f"""
SELECT pos, round({o.dot_sql('qv', 'dv')} / 0.05::DOUBLE, 6) AS logit FROM x5
""")
def vec_dot_logit(spark, sf_dir):
    x = fx.vector_pairs(spark, sf_dir)
    return x.select("pos", r6(V.dot_logit("qv", "dv", 0.05)).alias("logit"))


@query("vec_cosine", o.with_ctes(o.X5, _X5S) + f"""
SELECT x5.pos, round({o.dot_sql('qv', 'sv')} / ({o.norm_sql('qv')} * {o.norm_sql('sv')}), 6) AS cosine
FROM x5 JOIN x5s USING (pos)
""")
def vec_cosine(spark, sf_dir):
    x = fx.vector_pairs(spark, sf_dir)
    sv = F.zip_with(V.to_double("qv"), V.to_double("dv"), lambda a, b: a + b)
    return x.select("pos", r6(V.cosine("qv", sv)).alias("cosine"))


@query("vec_l1", o.with_ctes(o.X5) + """
SELECT pos, round(list_reduce(list_transform(generate_series(1, len(qv)), lambda i: abs(qv[i]::DOUBLE - dv[i]::DOUBLE)),
                              lambda s, x: s + x, 0.0::DOUBLE) / len(qv), 6) AS l1 FROM x5
""")
def vec_l1(spark, sf_dir):
    x = fx.vector_pairs(spark, sf_dir)
    return x.select("pos", r6(V.l1_mean("qv", "dv")).alias("l1"))
