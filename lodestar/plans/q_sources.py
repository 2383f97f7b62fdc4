"""Source queries (A1, A1b, A2, A3, A4, A5): fixtures are landed in the shared
scratch folder by Spark, then read back through the source operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.functions import text as T
from lodestar.operators.order import with_positions
from lodestar.operators.pairs import pairs_from_hits
from lodestar.plans import fixtures as fx
from lodestar.plans import oracle as o
from lodestar.plans.q_tokens import VOCAB, X8, x8
from lodestar.plans.registry import as_long, query, r6
from lodestar.session import scratch_path
from lodestar.sources.jsonl import read_pair_rejects, read_pairs_jsonl
from lodestar.sources.lines import read_lines, read_token_lines, write_lines
from lodestar.sources.npz import read_npz, write_npz
from lodestar.sources.sample import sample_pairs

P_SAMPLE, ROUNDS, SEED = 0.2, 5, 42
CAP = min(2 * 64, 100)


def land_jsonl(spark, sf_dir) -> str:
    path = scratch_path(spark, "pairs-jsonl")
    fx.pairs_jsonl_lines(spark, sf_dir).write.mode("overwrite").option("lineSep", "\n").text(path)
    return path


def land_jsonl_chunks(spark, sf_dir) -> str:
    """X1j in order: line ``pos`` of n goes to the file of folder ``chunk=<pos * X1J_CHUNKS div n>``, five digits."""
    path = scratch_path(spark, "pairs-jsonl-chunks")
    t = with_positions(fx.pairs_jsonl_in_order(spark, sf_dir), ["part", "at"])
    n = t.agg(F.count(F.lit(1)).alias("n"))
    t = t.join(F.broadcast(n)).select(F.lpad(F.expr(f"pos * {fx.X1J_CHUNKS} div n").cast("string"), 5, "0").alias("chunk"), "pos", "value")
    (t.repartition("chunk").sortWithinPartitions("chunk", "pos").select("chunk", "value")
     .write.partitionBy("chunk").option("lineSep", "\n").text(path))
    return path


#: SQL of the ordered lines: pair lines by pair_id, then the fixed ones, with (query, positive, rank) of good lines.
_REASONS = ", ".join(f"({i}, {'NULL' if r in (None, 'ok') else o.sql_str(r)}, {r == 'ok'}, {r is None})"
                     for i, (_, r) in enumerate(fx.X1J_EXTRA_LINES))
X1J_LINES = f"""
x1j_extra AS (SELECT * FROM (VALUES {_REASONS}) t(i, reason, good, blank)),
x1j AS (SELECT *, row_number() OVER (ORDER BY part, i) - 1 AS line, count(*) OVER () AS n FROM (
  SELECT 0 AS part, pair_id AS i, query, document AS positive, CAST({o.rank_default_sql('rank')} AS BIGINT) AS rank,
    CASE WHEN query = '' THEN 'missing_query' WHEN document = '' THEN 'missing_document' END AS reason, false AS blank
  FROM x1
  UNION ALL SELECT 1, e.i, g.query, g.positive, g.rank, e.reason, e.blank FROM x1j_extra e
  LEFT JOIN (SELECT *, row_number() OVER (ORDER BY i) AS k FROM x1j_extra WHERE good) ok ON ok.i = e.i
  LEFT JOIN (VALUES (1, 'q4', 'd4', 1), (2, 'q6', 'd6', 2)) g(k, query, positive, rank) ON g.k = ok.k))
"""


_EXTRA_OK = " UNION ALL ".join(
    f"SELECT {o.sql_str(q)} AS query, {o.sql_str(d)} AS positive, CAST({r} AS BIGINT) AS rank"
    for q, d, r in (("q4", "d4", 1), ("q6", "d6", 2)))


@query("src_pairs_jsonl", o.with_ctes(o.X1) + f"""
SELECT query, document AS positive, CAST({o.rank_default_sql('rank')} AS BIGINT) AS rank
FROM x1 WHERE query <> '' AND document <> ''
UNION ALL {_EXTRA_OK}
""")
def src_pairs_jsonl(spark, sf_dir):
    t = read_pairs_jsonl(spark, land_jsonl(spark, sf_dir))
    return t.select("query", "positive", as_long("rank").alias("rank"))


_EXTRA_REJ = {}
for _line, _reason in fx.X1J_EXTRA_LINES:
    if _reason not in (None, "ok"):
        _EXTRA_REJ[_reason] = _EXTRA_REJ.get(_reason, 0) + 1
_EXTRA_REJ_SQL = ", ".join(f"({o.sql_str(k)}, {v})" for k, v in _EXTRA_REJ.items())


@query("src_pairs_rejects", o.with_ctes(o.X1) + f"""
, r AS (SELECT CASE WHEN query = '' THEN 'missing_query' ELSE 'missing_document' END AS reason
        FROM x1 WHERE query = '' OR document = ''
        UNION ALL SELECT reason FROM (VALUES {_EXTRA_REJ_SQL}) t(reason, n), range(n))
SELECT reason, count(*) AS n_lines FROM r GROUP BY reason
""")
def src_pairs_rejects(spark, sf_dir):
    t = read_pair_rejects(spark, land_jsonl(spark, sf_dir))
    return t.groupBy("reason").agg(F.count(F.lit(1)).alias("n_lines"))


@query("src_pairs_reject_lines", o.with_ctes(o.X1, X1J_LINES) + f"""
SELECT CAST(chunk AS BIGINT) AS chunk, CAST(row_number AS BIGINT) AS line_no, reason FROM (
  SELECT reason, chunk, row_number() OVER (PARTITION BY chunk ORDER BY line) AS row_number
  FROM (SELECT *, line * {fx.X1J_CHUNKS} // n AS chunk FROM x1j)) WHERE reason IS NOT NULL
""")
def src_pairs_reject_lines(spark, sf_dir):
    """Rejects by file and line number."""
    t = read_pair_rejects(spark, land_jsonl_chunks(spark, sf_dir))
    return t.select(F.regexp_extract("file", r"chunk=(\d+)", 1).cast("bigint").alias("chunk"), "line_no", "reason")


_U_ROUND = f"(CAST(('0x' || substr(md5(concat_ws('|', CAST({SEED} + round AS VARCHAR), 'sample', CAST(doc_id AS VARCHAR))), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE)"


@query("src_random_sample_rounds", o.with_ctes(o.X2) + f"""
, s AS (SELECT * FROM (
          SELECT x2.*, r.round, row_number() OVER (PARTITION BY r.round ORDER BY u, doc_id) AS rn
          FROM (SELECT x2.*, r.range AS round, {_U_ROUND.replace('round', 'r.range')} AS u
                FROM x2, range({ROUNDS}) r) x2 JOIN (SELECT range AS round FROM range({ROUNDS})) r ON r.round = x2.round
          WHERE u < {P_SAMPLE}) WHERE rn <= {CAP})
SELECT round, doc_id, query, nullif(concat_ws(chr(10), nullif(title, ''), nullif(snippet, '')), '') AS positive,
       CAST({o.rank_default_sql('rank')} AS BIGINT) AS rank
FROM s WHERE query <> '' AND nullif(concat_ws(chr(10), nullif(title, ''), nullif(snippet, '')), '') <> ''
""")
def src_random_sample_rounds(spark, sf_dir):
    hits = fx.hits(spark, sf_dir)
    s = sample_pairs(hits, "doc_id", P_SAMPLE, SEED, ROUNDS, CAP)
    p = pairs_from_hits(s)
    p = p.filter(T.is_truthy("query") & T.is_truthy("positive"))
    return p.select("round", "doc_id", "query", "positive", as_long(T.rank_or_default("rank")).alias("rank"))


@query("src_random_sample", o.with_ctes(o.X2) + f"""
, s AS (SELECT x2.*, r.range AS round FROM x2, range({ROUNDS}) r WHERE {_U_ROUND.replace('round', 'r.range')} < {P_SAMPLE})
SELECT round, doc_id, query, nullif(concat_ws(chr(10), nullif(title, ''), nullif(snippet, '')), '') AS positive,
       CAST({o.rank_default_sql('rank')} AS BIGINT) AS rank
FROM s WHERE query <> '' AND nullif(concat_ws(chr(10), nullif(title, ''), nullif(snippet, '')), '') <> ''
""")
def src_random_sample(spark, sf_dir):
    """The rounds without a cap: every row drawn."""
    p = pairs_from_hits(sample_pairs(fx.hits(spark, sf_dir), "doc_id", P_SAMPLE, SEED, ROUNDS))
    p = p.filter(T.is_truthy("query") & T.is_truthy("positive"))
    return p.select("round", "doc_id", "query", "positive", as_long(T.rank_or_default("rank")).alias("rank"))


def land_versions(spark, df, col, name):
    root = scratch_path(spark, name)
    paths = {}
    for v in fx.VERSIONS:
        paths[v] = f"{root}/{v}"
        write_lines(df.filter(F.col("version") == v), paths[v], ["pos"], line=col)
    return paths


@query("src_text_lines", o.with_ctes(o.X3) + f"""
SELECT version, pos, {o.strip_sql('line')} AS line FROM x3
""")
def src_text_lines(spark, sf_dir):
    paths = land_versions(spark, fx.lines(spark, sf_dir), "line", "text-lines")
    return read_lines(spark, paths).select("version", "pos", "line")


@query("src_token_lines", o.with_ctes(o.X3, VOCAB, X8) + """
SELECT version, pos, token_line AS tokens FROM x8
""")
def src_token_lines(spark, sf_dir):
    # tokenized once: each version's sorted write reads its lines twice
    paths = land_versions(spark, x8(spark, sf_dir).checkpoint(eager=True), "token_line", "token-lines")
    t = read_token_lines(spark, paths)
    return t.select("version", "pos", F.array_join("tokens", " ").alias("tokens"))


@query("src_npz_vectors", o.with_ctes(o.X5) + """
SELECT pos, CAST(len(qv) AS BIGINT) AS dims, round(qv[1]::DOUBLE, 6) AS first, round(qv[len(qv)]::DOUBLE, 6) AS last FROM x5
""")
def src_npz_vectors(spark, sf_dir):
    x5 = fx.vector_pairs(spark, sf_dir)
    path = scratch_path(spark, "npz")
    write_npz(x5, path, "qv", rows_per_file=100).write.parquet(f"{path}-files")  # one row per written file
    t = read_npz(spark, path)
    return t.select("pos", as_long(F.size("embedding")).alias("dims"), r6(F.get("embedding", 0)).alias("first"),
                    r6(F.element_at("embedding", -1)).alias("last"))
