"""DuckDB spellings of the fixtures and helpers for the oracle SQL.

Each ``X*`` string is a list of CTEs (without the leading WITH) over the
driver's pre-registered views.  ``with_ctes`` joins them into one query.
"""

from __future__ import annotations

from lodestar.functions.text import WS_CLASS
from lodestar.plans import fixtures as fx


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def u_sql(seed, salt: str, *keys: str) -> str:
    """DuckDB form of ``functions.random.uniform``."""
    parts = [sql_str(str(seed)), sql_str(salt)] + [f"CAST({k} AS VARCHAR)" for k in keys]
    return f"(CAST(('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE)"


def hash_sql(seed, salt: str, *keys: str) -> str:
    parts = [sql_str(str(seed)), sql_str(salt)] + [f"CAST({k} AS VARCHAR)" for k in keys]
    return f"md5(concat_ws('|', {', '.join(parts)}))"


def words_sql(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WS_CLASS}+'), lambda w: w <> '')"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{WS_CLASS}+|{WS_CLASS}+$', '', 'g')"


def dot_sql(a: str, b: str) -> str:
    return (f"list_reduce(list_transform(generate_series(1, len({a})), "
            f"lambda i: {a}[i]::DOUBLE * {b}[i]::DOUBLE), lambda s, x: s + x, 0.0::DOUBLE)")


def norm_sql(a: str) -> str:
    return f"sqrt(list_reduce(list_transform({a}, lambda x: x::DOUBLE * x::DOUBLE), lambda s, x: s + x, 0.0::DOUBLE))"


def rank_weight_sql(r: str) -> str:
    rr = f"(CASE WHEN coalesce({r}, 1) <= 0 THEN 1 ELSE coalesce({r}, 1) END)"
    return f"(1.0 / log2(1.0 + CAST({rr} AS DOUBLE)))"


def rank_default_sql(r: str) -> str:
    d = f"TRY_CAST({r} AS DOUBLE)"
    return f"coalesce(CASE WHEN abs({d}) < 2.0e9 THEN CAST(trunc({d}) AS INTEGER) END, 1)"


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip().rstrip(",") for c in ctes) + "\n"


X1 = f"""
x1 AS (
  SELECT pid AS pair_id,
         CASE WHEN pid % {fx.X1_EMPTY_QUERY_MOD} = {fx.X1_EMPTY_QUERY_RES} THEN '' ELSE query END AS query,
         CASE WHEN pid % {fx.X1_EMPTY_DOC_MOD} = {fx.X1_EMPTY_DOC_RES} THEN '' ELSE document END AS document,
         CASE pid % {fx.X1_RANK_MOD}
           WHEN {fx.X1_NULL_RANK} THEN NULL WHEN {fx.X1_RANK_ZERO} THEN '0' WHEN {fx.X1_RANK_NEG} THEN '-1'
           WHEN {fx.X1_RANK_FLOAT} THEN '2.9' WHEN {fx.X1_RANK_TEXT} THEN 'x'
           ELSE CAST(1 + pid % 5 AS VARCHAR) END AS rank
  FROM (SELECT u.conv_id::BIGINT * {fx.X1_TURNS} + u.turn AS pid, u.text AS query, a.text AS document
        FROM conversations u JOIN conversations a
          ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
        WHERE u.role = 'user' AND a.role = 'assistant'))
"""

X2 = f"""
x2 AS (
  SELECT doc_id,
         array_to_string(list_slice({words_sql('text')}, 1, 3), ' ') AS query,
         CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE split_part(text, chr(10), 1) END AS title,
         CASE doc_id % 5 WHEN 2 THEN NULL WHEN 3 THEN ''
              ELSE (CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) END) END AS snippet,
         CAST(1 + doc_id % 4 AS VARCHAR) AS rank
  FROM documents)
"""

_EDGE = ", ".join(f"('v6', -1, {i}, {sql_str(s)})" for i, s in enumerate(fx.X8_EDGE_LINES))

X3 = f"""
x3_raw AS (
  SELECT 'v' || CAST(6 + doc_id % 3 AS VARCHAR) AS version, doc_id,
         CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS BIGINT) AS line_no,
         unnest(string_split(text, chr(10))) AS line
  FROM documents
  UNION ALL
  SELECT * FROM (VALUES {_EDGE}) t(version, doc_id, line_no, line)),
x3 AS (
  SELECT version, doc_id, line_no, line,
         row_number() OVER (PARTITION BY version ORDER BY doc_id, line_no) - 1 AS pos
  FROM x3_raw)
"""

X5 = f"""
x5 AS (
  SELECT q.pos, q.pos // {fx.X5_BATCH} AS batch_id, q.qv, d.dv,
         CAST(1 + q.pos % 5 AS INTEGER) AS rank,
         {rank_weight_sql('CAST(1 + q.pos % 5 AS INTEGER)')} AS weight
  FROM (SELECT vec_id // 2 AS pos, embedding AS qv FROM embeddings WHERE vec_id % 2 = 0) q
  JOIN (SELECT vec_id // 2 AS pos, embedding AS dv FROM embeddings WHERE vec_id % 2 = 1) d USING (pos))
"""

#: X5 with its one-pair batch and its batch of tied scores, under the name x5.
X5_BATCHES = X5.replace("x5 AS (", "x5_all AS (", 1).rstrip() + f""",
x5_edges AS (
  SELECT -1 AS batch_id, pos, qv, dv FROM x5_all WHERE pos = 0
  UNION ALL SELECT -2, a.pos, a.qv, b.dv FROM x5_all a JOIN x5_all b ON b.pos = a.pos - a.pos % 2 WHERE a.pos < 6),
x5 AS (SELECT * FROM x5_all UNION ALL
  SELECT batch_id * {fx.X5_BATCH} + pos, batch_id, qv, dv, 1, {rank_weight_sql('1')} FROM x5_edges)
"""

X6 = """
x6_base AS (
  SELECT vec_id, 't' || CAST(vec_id % 3 AS VARCHAR) AS task, embedding, label FROM embeddings),
x6_q AS (SELECT task, vec_id AS qid, embedding AS qv, label AS ql FROM x6_base WHERE vec_id % 10 = 0),
x6_c AS (SELECT task, vec_id AS did, embedding AS dv, label AS dl FROM x6_base WHERE vec_id % 10 <> 0),
x6_qrels AS (
  SELECT q.task, q.qid, c.did, 1 AS rel FROM x6_q q JOIN x6_c c
    ON q.task = c.task AND q.ql = c.dl)
"""

X6_HITS = f"""
x6_scored AS (SELECT q.task, q.qid, c.did, {dot_sql('q.qv', 'c.dv')} AS score
              FROM x6_q q JOIN x6_c c ON q.task = c.task),
x6_hits AS (
  SELECT * FROM (
    SELECT task, qid, did, score,
           row_number() OVER (PARTITION BY task, qid ORDER BY score DESC, did) AS rank
    FROM x6_scored) WHERE rank <= 10)
"""

X7 = """
x7 AS (
  SELECT vec_id // 5 AS id, CAST(vec_id % 5 AS INTEGER) AS tok_pos, CAST(embedding AS DOUBLE[]) AS hidden,
         CASE WHEN vec_id % 7 = 3 OR vec_id // 5 = 7 THEN 0 ELSE 1 END AS mask,
         CAST((vec_id // 5) % 5 AS INTEGER) AS eos_pos
  FROM embeddings)
"""

X9 = """
x9 AS (
  SELECT user_id % 4 AS run,
         row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) AS step,
         value AS loss,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS tokens,
         CASE WHEN event_id % 13 = 0 THEN 0.0::DOUBLE ELSE 0.25 * CAST(1 + event_id % 4 AS DOUBLE) END AS dt,
         event_type AS task,
         value / 500.0 AS score
  FROM events)
"""
