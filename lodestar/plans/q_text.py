"""Text-function, augmentation and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.functions import text as T
from lodestar.operators import augment as A
from lodestar.operators.order import shuffle
from lodestar.plans import fixtures as fx
from lodestar.plans import oracle as o
from lodestar.plans.registry import as_long, query, r6
from lodestar.sources.lines import union_versions

SEED = 42
KEYS = ("version", "pos")


# ---------------------------------------------------------------- pairs

@query("fn_compose_document", o.with_ctes(o.X2) + """
SELECT doc_id, nullif(concat_ws(chr(10), nullif(title, ''), nullif(snippet, '')), '') AS positive FROM x2
""")
def fn_compose_document(spark, sf_dir):
    x2 = fx.hits(spark, sf_dir)
    return x2.select("doc_id", T.compose_document("title", "snippet").alias("positive"))


@query("filter_valid_pairs", o.with_ctes(o.X1) + """
SELECT pair_id, query, document AS positive FROM x1 WHERE query <> '' AND document <> ''
""")
def filter_valid_pairs(spark, sf_dir):
    x1 = fx.raw_pairs(spark, sf_dir).withColumnRenamed("document", "positive")
    from lodestar.operators.pairs import valid_pairs
    return valid_pairs(x1).select("pair_id", "query", "positive")


@query("fn_rank_default", o.with_ctes(o.X1) + f"""
SELECT pair_id, rank AS rank_raw, CAST({o.rank_default_sql('rank')} AS BIGINT) AS rank FROM x1
""")
def fn_rank_default(spark, sf_dir):
    x1 = fx.raw_pairs(spark, sf_dir)
    return x1.select("pair_id", F.col("rank").alias("rank_raw"), as_long(T.rank_or_default("rank")).alias("rank"))


@query("fn_rank_weight", o.with_ctes(o.X1) + f"""
SELECT pair_id, round({o.rank_weight_sql(o.rank_default_sql('rank'))}, 6) AS weight FROM x1
""")
def fn_rank_weight(spark, sf_dir):
    x1 = fx.raw_pairs(spark, sf_dir)
    return x1.select("pair_id", r6(T.rank_weight(T.rank_or_default("rank"))).alias("weight"))


@query("fn_prompt_template", o.with_ctes(o.X1) + """
SELECT pair_id, '<unused0>' || query || '<eos>' AS q_prefix, '<unused1>' || document || '<eos>' AS d_prefix,
       query || '<unused0><eos>' AS q_suffix, document || '<unused1><eos>' AS d_suffix, query AS q_unprompted
FROM x1
""")
def fn_prompt_template(spark, sf_dir):
    x1 = fx.raw_pairs(spark, sf_dir)
    return x1.select(
        "pair_id",
        T.prompt("query", F.lit("query")).alias("q_prefix"),
        T.prompt("document", F.lit("document")).alias("d_prefix"),
        T.prompt("query", F.lit("query"), "suffix").alias("q_suffix"),
        T.prompt("document", F.lit("document"), "suffix").alias("d_suffix"),
        T.prompt("query", F.lit("system")).alias("q_unprompted"))


@query("fn_decode_utf8_lenient", o.with_ctes(o.X1) + """
SELECT pair_id, query || '!' || document AS decoded FROM x1
""")
def fn_decode_utf8_lenient(spark, sf_dir):
    """X1 as bytes with a truncated two-byte sequence (0xC3) spliced in; the
    malformed byte is dropped like ``decode('utf-8', errors='ignore')``."""
    x1 = fx.raw_pairs(spark, sf_dir)
    raw = F.concat(F.col("query").cast("binary"), F.unhex(F.lit("C3")), F.lit("!").cast("binary"),
                   F.unhex(F.lit("FF")), F.col("document").cast("binary"))
    return x1.select("pair_id", T.decode_lenient(raw).alias("decoded"))


# ---------------------------------------------------------------- lines

@query("fn_strip", o.with_ctes(o.X3) + f"""
SELECT version, pos, {o.strip_sql('line')} AS stripped FROM x3
""")
def fn_strip(spark, sf_dir):
    return fx.lines(spark, sf_dir).select("version", "pos", T.strip("line").alias("stripped"))


@query("union_versions", o.with_ctes(o.X3) + """
SELECT version, pos, line FROM x3
""")
def union_versions_q(spark, sf_dir):
    x3 = fx.lines(spark, sf_dir)
    parts = {v: x3.filter(F.col("version") == v).select("pos", "line") for v in fx.VERSIONS}
    return union_versions(parts).select("version", "pos", "line")


@query("shuffle_global", o.with_ctes(o.X3) + f"""
SELECT line_id, row_number() OVER (ORDER BY {o.hash_sql(SEED, 'shuffle', 'line_id')}, line_id) - 1 AS pos
FROM (SELECT version || ':' || CAST(pos AS VARCHAR) AS line_id FROM x3)
""")
def shuffle_global(spark, sf_dir):
    x3 = fx.lines(spark, sf_dir).select(F.concat_ws(":", "version", F.col("pos").cast("string")).alias("line_id"))
    return shuffle(x3, "line_id", SEED, pos="pos").select("line_id", "pos")


# ---------------------------------------------------------------- augmentations

def _u(salt):
    return o.u_sql(SEED, salt, "version", "pos")


def _rc(x: str) -> str:
    return f"array_to_string(list_reverse(string_split({x}, '')), '')"


def _shuffle_sql(parts: str, sep: str, salt: str) -> str:
    h = f"substr({o.hash_sql(SEED, salt, 'version', 'pos', '(i - 1) // 4')}, CAST(8 * ((i - 1) % 4) + 1 AS BIGINT), 8)"
    return (f"array_to_string(list_transform(list_sort(list_transform(generate_series(1, len({parts})), "
            f"lambda i: {{'h': {h}, 'i': i - 1, 'p': {parts}[i]}})), lambda s: s.p), '{sep}')")


_WS = o.words_sql("line")
AUG_SQL = {
    "sub": (f"CASE WHEN length(line) = 0 THEN line ELSE substring(line, st + 1, en - st) END"),
    "repeat": f"repeat(line, CAST(1 + floor({_u('repeat')} * 3) AS BIGINT))",
    "words": _shuffle_sql(_WS, " ", "words"),
    "chars": _shuffle_sql("string_split(line, '')", "", "chars"),
    "half": f"left(line, length(line) // 2) || {_rc('substr(line, length(line) // 2 + 1)')}",
    "word": (f"CASE WHEN len({_WS}) = 0 THEN line ELSE replace(line, {_WS}[CAST(floor({_u('word')} * len({_WS})) AS BIGINT) + 1], "
             f"{_rc(_WS + '[CAST(floor(' + _u('word') + ' * len(' + _WS + ')) AS BIGINT) + 1]')}) END"),
}
_X3S = f"""
x3s AS (SELECT *, CAST(floor({_u('sub_start')} * length(line)) AS BIGINT) AS st FROM x3),
x3a AS (SELECT *, st + 1 + CAST(floor({_u('sub_end')} * (length(line) - st)) AS BIGINT) AS en FROM x3s)
"""


def _aug_query(name, sql_key, col_fn):
    @query(name, o.with_ctes(o.X3, _X3S) + f"SELECT version, pos, {AUG_SQL[sql_key]} AS text FROM x3a")
    def q(spark, sf_dir):
        x3 = fx.lines(spark, sf_dir)
        kc = [F.col(k) for k in KEYS]
        return x3.select("version", "pos", col_fn(F.col("line"), kc).alias("text"))
    return q


_aug_query("aug_substring", "sub", lambda s, k: A.substring_random(s, SEED, *k))
_aug_query("aug_repeat", "repeat", lambda s, k: A.repeat_random(s, SEED, *k))
_aug_query("aug_shuffle_words", "words", lambda s, k: A.shuffle_words(s, SEED, *k))
_aug_query("aug_shuffle_chars", "chars", lambda s, k: A.shuffle_chars(s, SEED, *k))
_aug_query("aug_reverse_half", "half", lambda s, k: A.reverse_half(s))
_aug_query("aug_reverse_word", "word", lambda s, k: A.reverse_word(s, SEED, *k))


_PARTNER = f"""
x3g AS (SELECT *, row_number() OVER (ORDER BY version, pos) - 1 AS gpos,
               CAST(floor({_u('other')} * (SELECT count(*) FROM x3)) AS BIGINT) AS other FROM x3a),
x3p AS (SELECT a.*, b.line AS partner FROM x3g a LEFT JOIN x3g b ON b.gpos = a.other),
x3c AS (SELECT *, CASE WHEN {_u('order')} < 0.5 THEN partner || ' ' || line ELSE line || ' ' || partner END AS c4 FROM x3p)
"""


@query("aug_concat_random", o.with_ctes(o.X3, _X3S, _PARTNER) + """
SELECT version, pos, c4 AS text FROM x3c
""")
def aug_concat_random(spark, sf_dir):
    x3 = fx.lines(spark, sf_dir)
    t = A.concat_random(x3, "line", SEED, list(KEYS), dense_in=("version", "pos"))
    return t.select("version", "pos", "text")


_CASE = f"CAST(1 + floor({_u('case')} * 8) AS BIGINT)"


@query("aug_dispatch", o.with_ctes(o.X3, _X3S, _PARTNER) + f"""
SELECT version, pos, {_CASE} AS case_id,
       CASE {_CASE} WHEN 1 THEN line WHEN 2 THEN {AUG_SQL['sub']} WHEN 3 THEN {AUG_SQL['repeat']}
            WHEN 4 THEN c4 WHEN 5 THEN {AUG_SQL['words']} WHEN 6 THEN {AUG_SQL['chars']}
            WHEN 7 THEN {AUG_SQL['half']} ELSE {AUG_SQL['word']} END AS text
FROM x3c
""")
def aug_dispatch(spark, sf_dir):
    x3 = fx.lines(spark, sf_dir)
    t = A.augment(x3, "line", SEED, list(KEYS), dense_in=("version", "pos"))
    return t.select("version", "pos", as_long("case").alias("case_id"), "text")


@query("assign_role", o.with_ctes(o.X3) + f"""
SELECT version, pos, CASE WHEN {_u('role')} < 0.5 THEN 'query' ELSE 'document' END AS role FROM x3
""")
def assign_role(spark, sf_dir):
    x3 = fx.lines(spark, sf_dir)
    return x3.select("version", "pos", A.assign_role(SEED, *[F.col(k) for k in KEYS]).alias("role"))
