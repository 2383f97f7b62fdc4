"""Chains of operators as one query each: training batches from JSONL, and distillation samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.functions import arrays as AR
from lodestar.functions import text as T
from lodestar.functions import vectors as V
from lodestar.operators import augment as A
from lodestar.operators import teacher as D
from lodestar.operators import tokens as TK
from lodestar.operators.order import batch_fixed, with_positions
from lodestar.plans import fixtures as fx
from lodestar.plans import oracle as o
from lodestar.plans.q_sources import _EXTRA_OK, land_jsonl
from lodestar.plans.q_tokens import _MASK_SQL, VOCAB, X8, _tok_sql, _vec_sql, _vectors, vocab, x8
from lodestar.plans.registry import as_long, query, r6
from lodestar.session import drop_scratch, scratch_path, shuffles_dropped
from lodestar.sinks.samples import read_samples, write_samples
from lodestar.sources.jsonl import read_pairs_jsonl

BATCH, MAX_LEN, KEPT = 16, 256, 64
#: Samples are made in parts of about this many bytes of text and vectors, up to PARTS: what one part shuffles goes before the next.
PART_BYTES, PARTS = 1 << 27, 8

_PAIRS = f"""
jp AS (SELECT query, document AS positive, CAST({o.rank_default_sql('rank')} AS BIGINT) AS rank
       FROM x1 WHERE query <> '' AND document <> '' UNION ALL {_EXTRA_OK}),
jk AS (SELECT *, row_number() OVER (ORDER BY md5(query || chr(1) || positive || chr(1) || rank)) - 1 AS pos FROM jp),
jt_text AS (SELECT pos, 'query' AS role, '<unused0>' || query || '<eos>' AS text FROM jk
            UNION ALL SELECT pos, 'document', '<unused1>' || positive || '<eos>' FROM jk)
"""


@query("pipeline_training_batches", o.with_ctes(o.X1, o.X3, VOCAB, _PAIRS, _tok_sql("jt", "jt_text", "pos, role")) + f"""
, jb AS (SELECT jt.*, pos // {BATCH} AS batch_id, pos % {BATCH} AS slot, list_slice(tokens, 1, {MAX_LEN}) AS tr FROM jt),
jpad AS (SELECT *, list_concat(tr, list_transform(generate_series(1, blen - len(tr)), lambda i: 0)) AS ids
         FROM (SELECT *, max(len(tr)) OVER (PARTITION BY batch_id, role) AS blen FROM jb))
SELECT batch_id, slot, role, array_to_string(ids, ' ') AS input_ids, array_to_string({_MASK_SQL}, ' ') AS attention_mask,
       round({o.rank_weight_sql('jk.rank')}, 6) AS weight
FROM jpad JOIN jk USING (pos)
""")
def pipeline_training_batches(spark, sf_dir):
    """JSONL lines -> valid pairs -> fixed batches -> tokens -> padded, masked, weighted rows."""
    pairs = read_pairs_jsonl(spark, land_jsonl(spark, sf_dir))
    keyed = pairs.withColumn("_k", F.md5(F.concat_ws("\u0001", "query", "positive", F.col("rank").cast("string"))))
    b = batch_fixed(with_positions(keyed, ["_k"]), "pos", BATCH).select(
        "pos", "batch_id", "slot", "query", "positive", T.rank_weight("rank").alias("weight"))
    sides = F.explode(F.array(
        F.struct(F.lit("query").alias("role"), T.prompt("query", F.lit("query")).alias("text")),
        F.struct(F.lit("document").alias("role"), T.prompt("positive", F.lit("document")).alias("text"))))
    texts = b.select("pos", sides.alias("s")).select("pos", "s.*")
    toks = TK.tokenize(texts, ["pos", "role"], "text", vocab(spark, sf_dir), keep_input=False)
    rows = TK.pad_to_batch(toks.join(b.select("pos", "batch_id", "slot", "weight"), "pos"), "tokens", "batch_id",
                           MAX_LEN, by=["role"])
    return rows.select("batch_id", "slot", "role", F.array_join("input_ids", " ").alias("input_ids"),
                       F.array_join(AR.mask_special("input_ids"), " ").alias("attention_mask"), r6("weight").alias("weight"))


_ROLE = f"CASE WHEN {o.u_sql(42, 'role', 'version', 'pos')} < 0.5 THEN 'query' ELSE 'document' END"


@query("pipeline_distill_samples", o.with_ctes(o.X3, VOCAB, X8) + f"""
, qv AS ({_vec_sql(0, 'qv')}), dv AS ({_vec_sql(1, 'dv')}),
s AS (SELECT version, pos, {_ROLE} AS role,
             list_transform(list_filter(string_split(token_line, ' '), lambda x: x <> ''), lambda x: CAST(x AS INTEGER)) AS ids
      FROM x8),
t AS (SELECT s.*, list_concat([2, CASE role WHEN 'query' THEN 6 ELSE 7 END], list_slice(ids, 2, len(ids)), [1]) AS tokens,
             list_slice(CASE role WHEN 'query' THEN qv ELSE dv END, 1, {KEPT}) AS v
      FROM s JOIN qv USING (version, pos) JOIN dv USING (version, pos))
SELECT version, pos AS idx, role, array_to_string(tokens, ' ') AS tokenized, CAST(len(tokens) - 1 AS BIGINT) AS eos_pos,
       array_to_string(list_transform(v, lambda x: printf('%.4f', round(x::DOUBLE / {o.norm_sql('v')}, 4) + 0.0)), ' ') AS embedding
FROM t
""")
def pipeline_distill_samples(spark, sf_dir):
    """Token lines and both teachers aligned by position, one drawn role each: tokens, that role's
    whole vector, and the position of the closing <eos>; written as a version and read back against its manifest."""
    path = scratch_path(spark, "samples")
    with shuffles_dropped(spark):
        write_samples(_distill_parts(spark, sf_dir), path)
        samples = read_samples(spark, path)
    text = F.array_join(F.transform(V.divided("vector", "norm"), _four_decimals), " ")
    return samples.select(
        "version", F.col("pos").alias("idx"), "role", F.array_join("tokens", " ").alias("tokenized"),
        as_long("eos_pos").alias("eos_pos"), text.alias("embedding"))


def _four_decimals(x):
    """``%.4f`` of an element of a unit vector: as a decimal, which is rounded half up like ``round`` and has no -0."""
    return F.when(F.isnan(x), F.lit("NaN")).otherwise(x.cast("decimal(6,4)").cast("string"))


def _distill_parts(spark, sf_dir):
    """The samples, a DataFrame for each part of the positions.  Tokens are landed first, by shares of the
    documents; a part's tokens go when it has been written."""
    places = fx.line_places(spark, sf_dir)
    size = places.agg(F.sum(F.col("n_chars") + 4 * KEPT * F.col("n_lines"))).first()[0] or 0
    n = max(1, min(PARTS, -(-size // PART_BYTES)))
    part = F.pmod(F.xxhash64("version", "pos"), F.lit(n)).cast("int").alias("part")

    def land(df, path):
        df.select("*", part).write.mode("append").option("compression", "zstd").partitionBy("part").parquet(path)

    keys, tokens = scratch_path(spark, "line-keys"), scratch_path(spark, "line-tokens")
    land(fx.line_keys(places), keys)
    words = vocab(spark, sf_dir)
    for k in range(n):
        codes = scratch_path(spark, "token-codes")
        lines = x8(spark, sf_dir, fx.line_part(spark, sf_dir, places, k, n), words, codes)
        land(lines.select("version", "pos", AR.parse_ids("token_line").alias("ids")), tokens)
        drop_scratch(spark, codes)
    drawn = A.assign_role(42, F.col("version"), F.col("pos"))

    def taught(role):  # a position's key draws its role: the other role's vector is not carried
        return lambda v: F.when(drawn == role, V.truncate_dims(v, KEPT))

    for k in range(n):
        x3 = spark.read.schema("version string, pos long, part int").parquet(keys).filter(F.col("part") == k).drop("part")
        toks = spark.read.schema("version string, pos long, ids array<int>, part int").parquet(tokens).filter(F.col("part") == k).drop("part")
        rows = D.align(toks, _vectors(spark, sf_dir, x3, 0, "qv", taught("query")), _vectors(spark, sf_dir, x3, 1, "dv", taught("document")))
        one = rows.withColumn("role", drawn).select(
            "version", "pos", "role", D.role_tokens(F.col("ids"), F.col("role")).alias("tokens"),
            F.when(F.col("role") == "query", F.col("qv")).otherwise(F.col("dv")).alias("vector"))
        yield one.withColumn("norm", V.norm("vector")).withColumn("eos_pos", AR.last_eos("tokens"))
        drop_scratch(spark, f"{tokens}/part={k}")
