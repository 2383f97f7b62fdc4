"""Tokenization, token-array, batching and alignment queries
(B8-B13, B16, C7, E12, E13, K1, D1) over fixtures X1, X3, X4, X8."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.functions import arrays as AR
from lodestar.functions import text as T
from lodestar.functions import vectors as V
from lodestar.operators import teacher as D
from lodestar.operators import tokens as TK
from lodestar.operators.order import batch_fixed, with_positions
from lodestar.operators.pairs import valid_pairs
from lodestar.plans import fixtures as fx
from lodestar.plans import oracle as o
from lodestar.plans.registry import as_long, query, r6
from lodestar.session import scratch_path
from lodestar.sinks.batches import read_batches, write_batches

MAX_LEN = 256  # the loader's default
TRUNC = 24  # what arr_truncate cuts to
PAIR_BATCH = 32  # pairs in a batch
BUDGET, EPOCHS = 512, 3

_RES = ", ".join(f"({o.sql_str(t)}, {i})" for t, i in TK.RESERVED)
_RES_IN = ", ".join(o.sql_str(t) for t, _ in TK.RESERVED)

VOCAB = f"""
vocab AS (
  SELECT token, CAST(7 + row_number() OVER (ORDER BY n DESC, token) AS INTEGER) AS id FROM (
    SELECT token, count(*) AS n FROM (SELECT unnest({o.words_sql('line')}) AS token FROM x3)
    WHERE token NOT IN ({_RES_IN}) GROUP BY token)
  UNION ALL SELECT * FROM (VALUES {_RES}) r(token, id))
"""


def _tok_sql(name: str, src: str, keys: str) -> str:
    """CTE ``name`` = (keys, tokens) tokenizing ``text`` of ``src`` through ``vocab``."""
    k = [x.strip() for x in keys.split(",")]
    ws = o.words_sql(f"regexp_replace(text, '{TK.SPECIAL_PATTERN}', ' \\1 ', 'g')")
    return f"""
{name}_w AS (SELECT {keys}, {ws} AS ws FROM {src}),
{name}_x AS (SELECT {keys}, unnest(ws) AS token, generate_subscripts(ws, 1) AS i FROM {name}_w),
{name}_j AS (SELECT {', '.join('x.' + c for c in k)}, x.i, coalesce(v.id, 3) AS tid FROM {name}_x x LEFT JOIN vocab v USING (token)),
{name} AS (SELECT {', '.join('w.' + c for c in k)},
                  list_concat([2], coalesce((SELECT list(j.tid ORDER BY j.i) FROM {name}_j j
                                             WHERE {' AND '.join(f'j.{c} = w.{c}' for c in k)}), [])) AS tokens
           FROM {name}_w w)
"""


X4_TEXT = """
x4_text AS (
  SELECT pair_id, 'query' AS role, '<unused0>' || query || '<eos>' AS text FROM x1 WHERE query <> '' AND document <> ''
  UNION ALL
  SELECT pair_id, 'document' AS role, '<unused1>' || document || '<eos>' AS text FROM x1 WHERE query <> '' AND document <> '')
"""
X4 = X4_TEXT + "," + _tok_sql("x4", "x4_text", "pair_id, role")
X8 = ("x8_text AS (SELECT version, pos, line AS text FROM x3)," + _tok_sql("x8t", "x8_text", "version, pos") + f""",
x8 AS (SELECT version, pos, CASE WHEN len({o.words_sql('line')}) = 0 THEN '' ELSE array_to_string(t.tokens, ' ') END AS token_line
       FROM x3 JOIN x8t t USING (version, pos))
""")


def vocab(spark, sf_dir):
    """All words of the documents; no line positions are needed for it."""
    return TK.build_vocab(fx.line_words(spark, sf_dir), "line")


def x4_texts(spark, sf_dir):
    """Prompted query and document text of each valid X1 pair: (pair_id, role, text)."""
    x1 = valid_pairs(fx.raw_pairs(spark, sf_dir).withColumnRenamed("document", "positive"))
    q = x1.select("pair_id", F.lit("query").alias("role"), T.prompt("query", F.lit("query")).alias("text"))
    d = x1.select("pair_id", F.lit("document").alias("role"), T.prompt("positive", F.lit("document")).alias("text"))
    return q.unionByName(d)


def x4(spark, sf_dir):
    """X4 texts tokenized through the vocabulary join."""
    return TK.tokenize(x4_texts(spark, sf_dir), ["pair_id", "role"], "text", vocab(spark, sf_dir), keep_input=False)


def x8(spark, sf_dir, x3=None, words=None, codes=None):
    """X8 token lines: '2 id id ...' per X3 line, '' for a line without words."""
    x3 = x3 if x3 is not None else fx.lines(spark, sf_dir)
    words = words if words is not None else vocab(spark, sf_dir)
    t = TK.tokenize(x3, ["version", "pos"], "line", words, keep_input=False, codes=codes)
    # [BOS] alone means the line holds no word: it is written as a blank line.
    return t.select("version", "pos", F.when(F.size("tokens") == 1, F.lit(""))
                    .otherwise(F.array_join("tokens", " ")).alias("token_line"))


def _s(c):
    return F.array_join(c, " ")


@query("tok_vocab_build", o.with_ctes(o.X3, VOCAB) + "SELECT token, CAST(id AS BIGINT) AS id FROM vocab")
def tok_vocab_build(spark, sf_dir):
    return vocab(spark, sf_dir).select("token", as_long("id").alias("id"))


@query("tok_vocab_join", o.with_ctes(o.X1, o.X3, VOCAB, X4) + """
SELECT pair_id, role, array_to_string(tokens, ' ') AS tokens FROM x4
""")
def tok_vocab_join(spark, sf_dir):
    return x4(spark, sf_dir).select("pair_id", "role", _s("tokens").alias("tokens"))


@query("arr_truncate", o.with_ctes(o.X1, o.X3, VOCAB, X4) + f"""
SELECT pair_id, role, array_to_string(list_slice(tokens, 1, {TRUNC}), ' ') AS tokens FROM x4
""")
def arr_truncate(spark, sf_dir):
    return x4(spark, sf_dir).select("pair_id", "role", _s(AR.truncate("tokens", TRUNC)).alias("tokens"))


@query("arr_last_eos", o.with_ctes(o.X1, o.X3, VOCAB, X4) + f"""
SELECT pair_id, role, CAST(CASE WHEN list_contains(t, 1) THEN len(t) - list_position(list_reverse(t), 1) END AS BIGINT) AS eos_pos
FROM (SELECT pair_id, role, tokens AS t FROM x4)
""")
def arr_last_eos(spark, sf_dir):
    t = x4(spark, sf_dir)
    return t.select("pair_id", "role", as_long(AR.last_eos("tokens")).alias("eos_pos"))


@query("arr_mask_to_eos", o.with_ctes(o.X1, o.X3, VOCAB, X4) + f"""
SELECT pair_id, role, array_to_string(list_transform(generate_series(0, len(t) - 1),
         lambda i: CASE WHEN i <= coalesce(CASE WHEN list_contains(t, 1) THEN len(t) - list_position(list_reverse(t), 1) END, -1)
                        THEN 1 ELSE 0 END), ' ') AS mask
FROM (SELECT pair_id, role, tokens AS t FROM x4)
""")
def arr_mask_to_eos(spark, sf_dir):
    t = x4(spark, sf_dir)
    return t.select("pair_id", "role", _s(AR.mask_to_eos("tokens")).alias("mask"))


_BATCHED = f"""
x4k AS (SELECT pair_id, (row_number() OVER (ORDER BY pair_id) - 1) // {PAIR_BATCH} AS batch_id
        FROM x1 WHERE query <> '' AND document <> ''),
x4b AS (SELECT x4.*, batch_id, list_slice(tokens, 1, {MAX_LEN}) AS tr FROM x4 JOIN x4k USING (pair_id))
"""
_PADDED = _BATCHED + """,
x4p AS (SELECT *, list_concat(tr, list_transform(generate_series(1, blen - len(tr)), lambda i: 0)) AS ids
        FROM (SELECT *, max(len(tr)) OVER (PARTITION BY batch_id, role) AS blen FROM x4b))
"""


def x4_batched(spark, sf_dir):
    """X4 with the batch of its pair: PAIR_BATCH pairs in a row by pair_id, whatever the ids are."""
    pairs = valid_pairs(fx.raw_pairs(spark, sf_dir).withColumnRenamed("document", "positive")).select("pair_id")
    batches = batch_fixed(with_positions(pairs, ["pair_id"]), "pos", PAIR_BATCH).select("pair_id", "batch_id")
    return x4(spark, sf_dir).join(batches, "pair_id")


def padded(spark, sf_dir):
    return TK.pad_to_batch(x4_batched(spark, sf_dir), "tokens", "batch_id", MAX_LEN, by=["role"])


@query("agg_batch_maxlen", o.with_ctes(o.X1, o.X3, VOCAB, X4, _BATCHED) + f"""
SELECT batch_id, role, CAST(least(max(len(tokens)), {MAX_LEN}) AS BIGINT) AS max_len
FROM x4b GROUP BY ALL
""")
def agg_batch_maxlen(spark, sf_dir):
    return TK.batch_max_length(x4_batched(spark, sf_dir), "batch_id", "tokens", MAX_LEN, by=["role"]).select(
        "batch_id", "role", as_long("max_len").alias("max_len"))


@query("arr_pad_to_batch", o.with_ctes(o.X1, o.X3, VOCAB, X4, _PADDED) + """
SELECT pair_id, role, batch_id, array_to_string(ids, ' ') AS input_ids FROM x4p
""")
def arr_pad_to_batch(spark, sf_dir):
    return padded(spark, sf_dir).select("pair_id", "role", "batch_id", _s("input_ids").alias("input_ids"))


_MASK_SQL = "list_transform(ids, lambda t: CASE WHEN t IN (0, 1, 2) THEN 0 ELSE 1 END)"


@query("arr_mask_special", o.with_ctes(o.X1, o.X3, VOCAB, X4, _PADDED) + f"""
SELECT pair_id, role, array_to_string({_MASK_SQL}, ' ') AS attention_mask FROM x4p
""")
def arr_mask_special(spark, sf_dir):
    t = padded(spark, sf_dir)
    return t.select("pair_id", "role", _s(AR.mask_special("input_ids")).alias("attention_mask"))


@query("stats_batch_tokens", o.with_ctes(o.X1, o.X3, VOCAB, X4, _PADDED) + f"""
SELECT batch_id,
       CAST(sum(list_reduce(list_concat([0], {_MASK_SQL}), lambda a, b: a + b)) AS BIGINT) AS mask_tokens,
       CAST(sum(CASE WHEN list_contains(tokens, 1) THEN len(tokens) - list_position(list_reverse(tokens), 1) END) AS BIGINT) AS eos_tokens
FROM x4p GROUP BY batch_id
""")
def stats_batch_tokens(spark, sf_dir):
    from lodestar.operators.metrics import batch_tokens
    t = padded(spark, sf_dir).withColumn("attention_mask", AR.mask_special("input_ids")) \
        .withColumn("eos_pos", AR.last_eos("tokens"))  # of the uncut text
    return batch_tokens(t, "batch_id")


@query("sink_training_batches", o.with_ctes(o.X1, o.X3, VOCAB, X4, _PADDED) + f"""
SELECT x.pair_id, x.role, x.batch_id, array_to_string(x.ids, ' ') AS input_ids,
       array_to_string({_MASK_SQL}, ' ') AS attention_mask, round({o.rank_weight_sql(o.rank_default_sql('r.rank'))}, 6) AS weight
FROM x4p x JOIN x1 r USING (pair_id)
""")
def sink_training_batches(spark, sf_dir):
    x1 = fx.raw_pairs(spark, sf_dir).select("pair_id", T.rank_weight(T.rank_or_default("rank")).alias("weight"))
    t = padded(spark, sf_dir).join(x1, "pair_id").withColumn("attention_mask", AR.mask_special("input_ids"))
    path = scratch_path(spark, "batches")
    write_batches(t.select("pair_id", "role", "batch_id", "input_ids", "attention_mask", "weight"), path)
    back = read_batches(spark, path)
    return back.select("pair_id", "role", "batch_id", _s("input_ids").alias("input_ids"),
                       _s("attention_mask").alias("attention_mask"), r6("weight").alias("weight"))


# ---------------------------------------------------------------- token lines

@query("arr_role_splice", o.with_ctes(o.X3, VOCAB, X8) + """
SELECT version, pos, role, array_to_string(t, ' ') AS tokens,
       CAST(len(t) - list_position(list_reverse(t), 1) AS BIGINT) AS eos_pos FROM (
  SELECT version, pos, 'query' AS role,
         list_concat([2, 6], list_slice(ids, 2, len(ids)), [1]) AS t FROM (
    SELECT version, pos, list_transform(list_filter(string_split(token_line, ' '), lambda x: x <> ''), lambda x: CAST(x AS INTEGER)) AS ids FROM x8)
  UNION ALL
  SELECT version, pos, 'document' AS role,
         list_concat([2, 7], list_slice(ids, 2, len(ids)), [1]) AS t FROM (
    SELECT version, pos, list_transform(list_filter(string_split(token_line, ' '), lambda x: x <> ''), lambda x: CAST(x AS INTEGER)) AS ids FROM x8))
""")
def arr_role_splice(spark, sf_dir):
    t = x8(spark, sf_dir).select("version", "pos", AR.parse_ids("token_line").alias("ids"))
    return D.splice_roles(t, "ids").select("version", "pos", "role", _s("tokens").alias("tokens"),
                                           as_long("eos_pos").alias("eos_pos"))


@query("stats_token_budget", o.with_ctes(o.X3, VOCAB, X8) + f"""
SELECT version, n_tokens, n_tokens // {BUDGET} AS steps_per_epoch, (n_tokens // {BUDGET}) * {EPOCHS} AS total_steps,
       CAST(greatest(1, trunc(0.1::DOUBLE * ((n_tokens // {BUDGET}) * {EPOCHS}))) AS BIGINT) AS warmup_steps
FROM (SELECT version, CAST(sum(len(list_filter(string_split(token_line, ' '), lambda x: x <> ''))) AS BIGINT) AS n_tokens
      FROM x8 GROUP BY ROLLUP (version))
""")
def stats_token_budget(spark, sf_dir):
    from lodestar.operators.metrics import token_budget
    # a token line is [BOS] and one id per word, or blank: BOS stands for each line with a word
    lines = fx.line_words(spark, sf_dir).select("version", F.explode(F.split("line", "\n", -1)).alias("line"))
    words = F.concat_ws(" ", F.lit("2"), "line")
    return token_budget(lines.filter(F.size(T.split_words("line")) > 0).withColumn("line", words),
                        "line", BUDGET, EPOCHS)


def _vectors(spark, sf_dir, x3, shift: int, name: str, of=None):
    """Vectors by position: vec_id = (3 * pos + version index + shift) mod N.  ``of`` makes what is carried
    with a position from its column ``name``, so that no more than that is shuffled to the other sources."""
    e = fx.table(spark, sf_dir, "embeddings")
    n = e.count()
    vidx = F.col("version").substr(2, 1).cast("int") - 6
    keyed = x3.select("version", "pos", F.pmod(F.col("pos") * 3 + vidx + shift, F.lit(n)).alias("vec_id"))
    t = keyed.join(e.select("vec_id", F.col("embedding").alias(name)), "vec_id").drop("vec_id")
    return t if of is None else t.withColumn(name, of(F.col(name)))


def _vec_sql(shift: int, name: str) -> str:
    return (f"SELECT version, pos, e.embedding AS {name} FROM x3 JOIN embeddings e "
            f"ON e.vec_id = (3 * pos + CAST(substr(version, 2, 1) AS INTEGER) - 6 + {shift}) % (SELECT count(*) FROM embeddings)")


@query("join_positional", o.with_ctes(o.X3, VOCAB, X8) + f"""
, qv AS ({_vec_sql(0, 'qv')}), dv AS ({_vec_sql(1, 'dv')})
SELECT version, pos, CAST(len(list_filter(string_split(token_line, ' '), lambda x: x <> '')) AS BIGINT) AS n_tokens,
       round(qv[1] / {o.norm_sql('qv')}, 6) AS q0, round(dv[1] / {o.norm_sql('dv')}, 6) AS d0
FROM x8 JOIN qv USING (version, pos) JOIN dv USING (version, pos)
""")
def join_positional(spark, sf_dir):
    x3 = fx.lines(spark, sf_dir)
    toks = x8(spark, sf_dir, x3)
    def first(v):
        return r6(F.element_at(V.l2_normalize(V.truncate_dims(v, 640)), 1))

    q = _vectors(spark, sf_dir, x3, 0, "qv", first)
    d = _vectors(spark, sf_dir, x3, 1, "dv", first)
    sizes = toks.select("version", "pos", as_long(F.size(T.split_words("token_line"))).alias("n_tokens"))
    j = D.align(sizes, q, d, on=("version", "pos"))
    return j.select("version", "pos", "n_tokens", F.col("qv").alias("q0"), F.col("dv").alias("d0"))


@query("check_alignment", o.with_ctes(o.X3, VOCAB, X8) + f"""
, qv AS ({_vec_sql(0, 'qv')}), dv AS ({_vec_sql(1, 'dv')} WHERE NOT (version = 'v7' AND pos = 0)),
c AS (SELECT version, (SELECT count(*) FROM x8 t WHERE t.version = v.version) AS n_tokens,
             (SELECT count(*) FROM qv t WHERE t.version = v.version) AS n_query,
             (SELECT count(*) FROM dv t WHERE t.version = v.version) AS n_doc
      FROM (SELECT DISTINCT version FROM x3) v)
SELECT version, n_tokens, n_query, n_doc, n_tokens = n_query AND n_tokens = n_doc AS ok FROM c
""")
def check_alignment(spark, sf_dir):
    x3 = fx.lines(spark, sf_dir)
    q = _vectors(spark, sf_dir, x3, 0, "qv")
    d = _vectors(spark, sf_dir, x3, 1, "dv").filter(~((F.col("version") == "v7") & (F.col("pos") == 0)))
    c = D.check_alignment({"tokens": x8(spark, sf_dir, x3), "query": q, "doc": d})
    return c.select("version", as_long("n_tokens").alias("n_tokens"), as_long("n_query").alias("n_query"),
                    as_long("n_doc").alias("n_doc"), "ok")
