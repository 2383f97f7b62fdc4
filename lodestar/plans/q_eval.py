"""Retrieval evaluation queries (D6, D7, E9-E11, F4, A7) over fixture X6."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators import retrieval as rt
from lodestar.operators.evaluate import evaluate_texts
from lodestar.operators.judgments import by_passage
from lodestar.plans import fixtures as fx
from lodestar.plans import oracle as o
from lodestar.plans.q_udf import encoder_sql
from lodestar.plans.registry import as_long, query, r6
from lodestar.sources.eval_tables import load_eval

KS = (1, 5, 10)
REQUESTED_TASKS = ("t0", "t1", "t2", "t9")


def hits_and_qrels(spark, sf_dir):
    queries, corpus = fx.retrieval_sets(spark, sf_dir)
    return rt.retrieve(queries, corpus, k=max(KS)), rt.ClassJudgments(queries, corpus)


@query("retrieve_topk", o.with_ctes(o.X6, o.X6_HITS) + """
SELECT task, qid, did, round(score, 6) AS score, CAST(rank AS BIGINT) AS rank FROM x6_hits
""")
def retrieve_topk(spark, sf_dir):
    h, _ = hits_and_qrels(spark, sf_dir)
    return h.select("task", as_long("qid").alias("qid"), as_long("did").alias("did"),
                    r6("score").alias("score"), as_long("rank").alias("rank"))


def _ndcg_sql_body() -> str:
    dcg = ", ".join(f"sum(CASE WHEN rank <= {k} THEN rel * (1.0 / log2(rank + 1.0)) ELSE 0.0 END) AS d{k}" for k in KS)
    idcg = ", ".join(f"sum(CASE WHEN i <= {k} THEN rel * (1.0 / log2(i + 1.0)) ELSE 0.0 END) AS i{k}" for k in KS)
    per = ", ".join(f"coalesce(d.d{k}, 0.0) / i.i{k} AS ndcg_at_{k}" for k in KS)
    return f""",
judged AS (SELECT h.task, h.qid, h.did, h.rank, CAST(coalesce(r.rel, 0) AS DOUBLE) AS rel
           FROM x6_hits h LEFT JOIN x6_qrels r USING (task, qid, did)),
dcg AS (SELECT task, qid, {dcg} FROM judged GROUP BY task, qid),
ideal AS (SELECT task, qid, {idcg} FROM (
            SELECT task, qid, CAST(rel AS DOUBLE) AS rel,
                   row_number() OVER (PARTITION BY task, qid ORDER BY rel DESC, did) AS i
            FROM x6_qrels WHERE rel > 0) WHERE i <= {max(KS)} GROUP BY task, qid),
per_q AS (SELECT i.task, i.qid, {per} FROM ideal i LEFT JOIN dcg d USING (task, qid))
"""


_NDCG_TALL = " UNION ALL ".join(
    f"SELECT task, 'test' AS split, 'ndcg' AS metric, CAST({k} AS BIGINT) AS k, round(avg(ndcg_at_{k}), 6) AS score "
    f"FROM per_q GROUP BY task" for k in KS)


@query("eval_ndcg", o.with_ctes(o.X6, o.X6_HITS) + _ndcg_sql_body() + _NDCG_TALL)
def eval_ndcg(spark, sf_dir):
    h, qrels = hits_and_qrels(spark, sf_dir)
    t = rt.task_scores(rt.ndcg(h, qrels, KS))
    return t.select("task", "split", "metric", as_long("k").alias("k"), r6("score").alias("score"))


def _rank_metrics_sql() -> str:
    per = []
    for k in KS:
        per += [
            f"CAST(sum(CASE WHEN rank <= {k} THEN isrel ELSE 0 END) AS DOUBLE) / {k}.0 AS precision_at_{k}",
            f"CAST(sum(CASE WHEN rank <= {k} THEN isrel ELSE 0 END) AS DOUBLE) / max(r.n_rel) AS recall_at_{k}",
            f"coalesce(sum(CASE WHEN rank <= {k} AND isrel = 1 THEN cum / rank END), 0.0) / max(r.n_rel) AS map_at_{k}",
            f"coalesce(max(CASE WHEN rank <= {k} AND isrel = 1 THEN 1.0 / rank END), 0.0) AS mrr_at_{k}",
        ]
    tall = []
    for k in KS:
        for m in ("precision", "recall", "map", "mrr"):
            tall.append(f"SELECT task, 'test' AS split, '{m}' AS metric, CAST({k} AS BIGINT) AS k, "
                        f"round(avg({m}_at_{k}), 6) AS score FROM per_q GROUP BY task")
    return f""",
judged AS (SELECT h.task, h.qid, h.did, h.rank, CASE WHEN coalesce(q.rel, 0) > 0 THEN 1 ELSE 0 END AS isrel
           FROM x6_hits h LEFT JOIN x6_qrels q USING (task, qid, did)),
cum AS (SELECT *, sum(isrel) OVER (PARTITION BY task, qid ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
        FROM judged),
rel_n AS (SELECT task, qid, count(*) AS n_rel FROM x6_qrels WHERE rel > 0 GROUP BY task, qid),
per_q AS (SELECT r.task, r.qid, {', '.join(per)}
          FROM rel_n r LEFT JOIN cum c ON c.task = r.task AND c.qid = r.qid GROUP BY r.task, r.qid)
""" + " UNION ALL ".join(tall)


@query("eval_rank_metrics", o.with_ctes(o.X6, o.X6_HITS) + _rank_metrics_sql())
def eval_rank_metrics(spark, sf_dir):
    h, qrels = hits_and_qrels(spark, sf_dir)
    t = rt.task_scores(rt.rank_metrics(h, qrels, KS))
    return t.select("task", "split", "metric", as_long("k").alias("k"), r6("score").alias("score"))


def by_task_text(col):
    """The by-task map as text, task=score in order of tasks."""
    pairs = F.array_sort(F.map_entries(F.coalesce(F.col(col), F.create_map().cast("map<string,double>"))))
    return F.array_join(F.transform(pairs, lambda e: F.format_string("%s=%.6f", e["key"], e["value"])), ",").alias(col)


_REQ = ", ".join(f"({o.sql_str(t)})" for t in REQUESTED_TASKS)


@query("eval_macro_average", o.with_ctes(o.X6, o.X6_HITS) + _ndcg_sql_body() + f""",
per_task AS (SELECT task, avg(ndcg_at_5) AS score FROM per_q GROUP BY task),
req AS (SELECT * FROM (VALUES {_REQ}) t(task))
SELECT coalesce(string_agg(task || '=' || printf('%.6f', p.score), ',' ORDER BY task) FILTER (p.score IS NOT NULL), '')
         AS ndcg_at_5_by_task,
       round(coalesce(avg(p.score), 0.0), 6) AS avg_ndcg_at_5,
       CAST(count(*) AS BIGINT) AS total_tasks, CAST(count(p.score) AS BIGINT) AS valid_tasks
FROM req r LEFT JOIN per_task p USING (task)
""")
def eval_macro_average(spark, sf_dir):
    h, qrels = hits_and_qrels(spark, sf_dir)
    scores = rt.task_scores(rt.ndcg(h, qrels, KS))
    s = rt.macro_average(scores, tasks=REQUESTED_TASKS, metric="ndcg", k=5)
    return s.select(by_task_text("ndcg_at_5_by_task"), r6("avg_ndcg_at_5").alias("avg_ndcg_at_5"), as_long("total_tasks").alias("total_tasks"),
                    as_long("valid_tasks").alias("valid_tasks"))


@query("src_eval_tables", o.with_ctes(o.X6) + """
SELECT 'queries' AS kind, task, CAST(count(*) AS BIGINT) AS n FROM x6_q WHERE task IN ('t0', 't2') GROUP BY task
UNION ALL SELECT 'corpus', task, CAST(count(*) AS BIGINT) FROM x6_c WHERE task IN ('t0', 't2') GROUP BY task
UNION ALL SELECT 'qrels', task, CAST(count(*) AS BIGINT) FROM x6_qrels WHERE task IN ('t0', 't2') GROUP BY task
""")
def src_eval_tables(spark, sf_dir):
    q, c = load_eval(*fx.retrieval_sets(spark, sf_dir), tasks=("t0", "t2"))
    parts = [df.groupBy("task").agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "task", "n")
             for kind, df in (("queries", q), ("corpus", c))]
    judged = rt.ClassJudgments(q, c).count_by_task().select(F.lit("qrels").alias("kind"), "task", "n")
    return parts[0].unionByName(parts[1]).unionByName(judged)


#: Tasks of the text evaluation: documents by language, benchmark items against each; one that has no document.
TEXT_TASKS = ("de", "en", "es", "fr", "xx")
_TT = ", ".join(f"({o.sql_str(t)})" for t in TEXT_TASKS)


@query("eval_texts", f"""
WITH tasks AS (SELECT * FROM (VALUES {_TT}) t(task)),
tq AS (SELECT task, item_id AS qid, text FROM benchmark, tasks),
td AS (SELECT lang AS task, doc_id AS did, text FROM documents WHERE lang IN (SELECT task FROM tasks)),
qw AS (SELECT task, qid, {o.words_sql("lower(coalesce(text, ''))")} AS w FROM tq),
dw AS (SELECT task, did, {o.words_sql("lower(coalesce(text, ''))")} AS w FROM td),
qp AS (SELECT DISTINCT task, qid, n, array_to_string(w[i : i + n - 1], ' ') AS p FROM (
  SELECT task, qid, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM qw WHERE len(w) > 0)),
dp AS (SELECT DISTINCT task, did, n, array_to_string(w[i : i + n - 1], ' ') AS p FROM (
  SELECT task, did, w, n, unnest(range(1, len(w) - n + 2)) AS i
  FROM dw JOIN (SELECT DISTINCT task, n FROM qp) USING (task) WHERE len(w) >= n)),
x6_qrels AS (SELECT DISTINCT task, qid, did, 1 AS rel FROM qp JOIN dp USING (task, n, p)),
src AS (SELECT task, qid AS id, 'query' AS role, text FROM tq UNION ALL SELECT task, did, 'document', text FROM td),
{encoder_sql("src", "task, id, role", "eos")},
vec AS (SELECT task, id, role, list(raw ORDER BY dim) AS v FROM enc_raw GROUP BY ALL),
x6_hits AS (SELECT task, qid, did, row_number() OVER (PARTITION BY task, qid ORDER BY score DESC, did) AS rank FROM (
  SELECT q.task, q.id AS qid, d.id AS did, round({o.dot_sql('q.v', 'd.v')}, 9) AS score
  FROM vec q JOIN vec d ON q.task = d.task AND q.role = 'query' AND d.role = 'document')
  QUALIFY rank <= 10)
""" + _ndcg_sql_body() + """,
per_task AS (SELECT task, avg(ndcg_at_5) AS score FROM per_q GROUP BY task)
SELECT coalesce(string_agg(task || '=' || printf('%.6f', p.score), ',' ORDER BY task) FILTER (p.score IS NOT NULL), '')
         AS ndcg_at_5_by_task,
       round(coalesce(avg(p.score), 0.0), 6) AS avg_ndcg_at_5,
       CAST(count(*) AS BIGINT) AS total_tasks, CAST(count(p.score) AS BIGINT) AS valid_tasks
FROM tasks LEFT JOIN per_task p USING (task)
""")
def eval_texts(spark, sf_dir):
    """Benchmark items against whole documents of each language: judged by passage, encoded, retrieved, scored."""
    b, d = fx.table(spark, sf_dir, "benchmark"), fx.table(spark, sf_dir, "documents")
    tasks = F.explode(F.array(*[F.lit(t) for t in TEXT_TASKS]))
    queries = b.select(tasks.alias("task"), F.col("item_id").alias("qid"), "text")
    corpus = d.select(F.col("lang").alias("task"), F.col("doc_id").alias("did"), "text")
    summary, _ = evaluate_texts(queries, corpus, by_passage(queries, corpus), TEXT_TASKS)
    return summary.select(by_task_text("ndcg_at_5_by_task"), r6("avg_ndcg_at_5").alias("avg_ndcg_at_5"),
                          as_long("total_tasks").alias("total_tasks"), as_long("valid_tasks").alias("valid_tasks"))
