"""Pooling (E1, E2) and plug-in queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators import encode as EN
from lodestar.operators import pooling as PL
from lodestar.plans import fixtures as fx
from lodestar.plans import oracle as o
from lodestar.plans.q_tokens import VOCAB, X4, vocab
from lodestar.plans.registry import as_long, query, r6
from lodestar.session import scratch_path


def _long(df, vec="embedding"):
    t = df.select("id", F.posexplode(vec).alias("dim", "value"))
    return t.select("id", as_long("dim").alias("dim"), r6("value").alias("value"))


@query("pool_mean", o.with_ctes(o.X7) + """
SELECT id, CAST(dim AS BIGINT) AS dim, round(sum(x * mask) / greatest(sum(mask), 1), 6) AS value FROM (
  SELECT id, mask, generate_subscripts(hidden, 1) - 1 AS dim, unnest(hidden) AS x FROM x7) GROUP BY id, dim
""")
def pool_mean(spark, sf_dir):
    return _long(PL.pool_mean(fx.hidden_states(spark, sf_dir)))


@query("pool_eos", o.with_ctes(o.X7) + f"""
SELECT id, CAST(dim AS BIGINT) AS dim, round(x / n, 6) AS value FROM (
  SELECT id, generate_subscripts(hidden, 1) - 1 AS dim, unnest(hidden) AS x, {o.norm_sql('hidden')} AS n
  FROM x7 WHERE tok_pos = eos_pos)
""")
def pool_eos(spark, sf_dir):
    return _long(PL.pool_eos(fx.hidden_states(spark, sf_dir)))


@query("udf_tokenize", o.with_ctes(o.X1, o.X3, VOCAB, X4) + """
SELECT pair_id, role, array_to_string(tokens, ' ') AS tokens FROM x4
""")
def udf_tokenize(spark, sf_dir):
    """The vocabulary tokenizer as a plug-in: vocabulary landed as Parquet once, its most frequent
    words loaded once per Python worker, applied by Arrow batches; rarer words come with their texts."""
    from lodestar.plans.q_tokens import x4_texts
    path = scratch_path(spark, "vocab")
    vocab(spark, sf_dir).select("token", "id").write.mode("overwrite").parquet(path)
    tok = EN.tokenize_udf(EN.VocabTokenizer.factory(path))
    t = EN.with_rare_words(x4_texts(spark, sf_dir), "text", spark.read.schema("token string, id int").parquet(path))
    return t.select("pair_id", "role", F.array_join(tok("text", "rare_words", "rare_ids"), " ").alias("tokens"))


DIMS, KEPT = EN.HASH_DIMS, 32


def encoder_sql(src: str, keys: str, pooling: str, dims: int = DIMS) -> str:
    """CTE ``enc`` = (keys, dim, value) of the default encoder over ``src`` (keys, role, text)."""
    k = ", ".join(f"t.{x.strip()}" for x in keys.split(","))
    draws = ", ".join(f"CAST('0x' || substr(h{i // 8}, {4 * (i % 8) + 1}, 4) AS BIGINT) - 32768" for i in range(DIMS))
    hashes = ", ".join(f"md5('0|vector{b}|' || tok) AS h{b}" for b in range(-(-DIMS // 8)))
    weight = "1" if pooling == "mean" else "1 + i % 7"
    words = o.words_sql("coalesce(text, '')")
    return f"""
enc_t AS (SELECT *, list_concat(['<bos>', CASE role WHEN 'query' THEN '<unused0>' ELSE '<unused1>' END],
                                {words}, ['<eos>']) AS toks FROM {src}),
enc_x AS (SELECT {keys}, unnest(toks) AS tok, unnest(range(len(toks))) AS i FROM enc_t),
enc_w AS (SELECT {keys}, tok, sum({weight})::BIGINT AS w FROM enc_x GROUP BY ALL),
enc_d AS (SELECT {keys}, w, [{draws}] AS v FROM (SELECT *, {hashes} FROM enc_w)),
enc_l AS (SELECT {keys}, unnest(range({DIMS})) AS dim, unnest(v) * w AS x FROM enc_d),
enc_s AS (SELECT {keys}, dim, sum(x)::BIGINT AS s FROM enc_l WHERE dim < {dims} GROUP BY ALL),
enc_raw AS (SELECT {keys}, dim, s / sqrt(sum(s::DOUBLE * s) OVER (PARTITION BY {keys})) AS raw FROM enc_s),
enc AS (SELECT {keys}, dim, round(raw, 6) AS value FROM enc_raw)
"""


@query("encode_texts", "WITH src AS (SELECT doc_id, 'document' AS role, text FROM documents),"
       + encoder_sql("src", "doc_id", "mean") + "SELECT doc_id, CAST(dim AS BIGINT) AS dim, value FROM enc")
def encode_texts(spark, sf_dir):
    """Whole documents through the default encoder, mean pooling, normalised."""
    d = fx.table(spark, sf_dir, "documents").select("doc_id", "text")
    t = EN.hash_encode(d, "doc_id", "text", F.lit("document"))
    return t.select("doc_id", F.posexplode("embedding").alias("dim", "value")).select(
        "doc_id", as_long("dim").alias("dim"), r6("value").alias("value"))


@query("encode_batched", "WITH src AS (SELECT doc_id, 'document' AS role, text FROM documents),"
       + encoder_sql("src", "doc_id", "eos") + "SELECT doc_id, CAST(dim AS BIGINT) AS dim, value FROM enc")
def encode_batched(spark, sf_dir):
    """Whole documents through a plug-in encoder, 64 at a time, EOS pooling, normalised."""
    d = fx.table(spark, sf_dir, "documents").select("doc_id", "text")
    t = EN.encode_texts(d, "text", F.lit("document"), EN.DrawEncoder.factory(), pooling="eos", element="double")
    return t.select("doc_id", F.posexplode("embedding").alias("dim", "value")).select(
        "doc_id", as_long("dim").alias("dim"), r6("value").alias("value"))


@query("attach_embeddings", """WITH src AS (
  SELECT item_id AS id, 'query' AS role, text FROM benchmark UNION ALL SELECT doc_id, 'document', text FROM documents),"""
       + encoder_sql("src", "id, role", "eos", KEPT) + "SELECT id, role, CAST(dim AS BIGINT) AS dim, value FROM enc")
def attach_embeddings(spark, sf_dir):
    """Benchmark items (queries) and documents, EOS pooling, teacher vectors cut to the first dimensions."""
    b = fx.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text", F.lit("query").alias("role"))
    d = fx.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", F.lit("document").alias("role"))
    t = EN.attach_embeddings(b.unionByName(d), "text", EN.DrawEncoder.factory(), KEPT, pooling="eos", element="double")
    return t.select("id", "role", F.posexplode("embedding").alias("dim", "value")).select(
        "id", "role", as_long("dim").alias("dim"), r6("value").alias("value"))
