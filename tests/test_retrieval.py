"""Exact retrieval: any number of tiles agrees with all pairs; judgments by class equal listed pairs;
NDCG against a direct computation."""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestar.operators import retrieval as rt
from lodestar.plans import fixtures as fx
from tests.conftest import SF_SMALL


def _hits(df):
    return {(r.task, r.qid, r.rank): (r.did, round(r.score, 9)) for r in df.collect()}


def test_tiles_agree_with_all_pairs(spark):
    q, c = fx.retrieval_sets(spark, SF_SMALL)
    twins = c.limit(40).withColumn("did", F.col("did") + 1_000_000)   # equal scores: the smaller did goes first
    c = c.unionByName(twins)
    from lodestar.functions.vectors import dot
    w = Window.partitionBy("task", "qid").orderBy(F.col("score").desc(), "did")
    want = _hits(q.join(c, "task").select("task", "qid", "did", dot("qv", "dv").alias("score"))
                 .withColumn("rank", F.row_number().over(w)).filter("rank <= 10"))
    assert _hits(rt.retrieve(q, c, 10)) == want
    assert _hits(rt.retrieve(q, c.repartition(7), 10, tile_bytes=8 * 64 * 5)) == want
    assert _hits(rt.retrieve(q.repartition(3), c, 10, tile_bytes=8 * 64 * 40)) == want


def test_rounded_scores_tie(spark):
    q = spark.createDataFrame([("t", 1, [1.0, 1e-13])], "task string, qid long, qv array<double>")
    c = spark.createDataFrame([("t", d, [0.5, x]) for d, x in ((3, 1.0), (2, 0.0), (1, -1.0), (4, 900.0))],
                              "task string, did long, dv array<double>")
    assert [r.did for r in rt.retrieve(q, c, 4).orderBy("rank").collect()] == [4, 3, 2, 1]
    assert [r.did for r in rt.retrieve(q, c, 4, decimals=9).orderBy("rank").collect()] == [1, 2, 3, 4]


def test_class_judgments_equal_listed_pairs(spark):
    q, c = fx.retrieval_sets(spark, SF_SMALL)
    hits = rt.retrieve(q, c, 10)
    pairs = (q.select("task", "qid", "class").join(c.select("task", "did", "class"), ["task", "class"])
             .select("task", "qid", "did", F.lit(1).alias("rel")))
    by_class = rt.ClassJudgments(q, c)
    for f in (rt.ndcg, rt.rank_metrics):
        a, b = ({(r.task, r.qid): [round(x, 12) for x in r[2:]] for r in f(hits, j).collect()} for j in (pairs, by_class))
        assert a == b and len(a) > 20
    n = {r.task: r.n for r in by_class.count_by_task().collect()}
    assert n == {r.task: r["count"] for r in pairs.groupBy("task").count().collect()}


def test_scored_pairs_are_not_listed_and_queries_stay_on_executors(spark, monkeypatch):
    q, c = fx.retrieval_sets(spark, SF_SMALL)
    kind = type(q)
    for action in ("toArrow", "collect", "toPandas", "count", "first", "toLocalIterator"):
        monkeypatch.setattr(kind, action, lambda *a, **k: (_ for _ in ()).throw(AssertionError("driver action")))
    plan = rt.retrieve(q, c, 10)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_retrieval_of_empty_sets(spark):
    q, c = fx.retrieval_sets(spark, SF_SMALL)
    assert rt.retrieve(q.limit(0), c, 3).count() == 0
    assert rt.retrieve(q, c.limit(0), 3).count() == 0


def test_ndcg_by_hand(spark):
    hits = spark.createDataFrame([("t", 1, 10, 0.9, 1), ("t", 1, 11, 0.8, 2), ("t", 1, 12, 0.7, 3),
                                  ("t", 2, 20, 0.5, 1)],
                                 "task string, qid long, did long, score double, rank int")
    qrels = spark.createDataFrame([("t", 1, 11, 1), ("t", 1, 13, 2), ("t", 3, 30, 1)],
                                  "task string, qid long, did long, rel int")
    got = {r.qid: r for r in rt.ndcg(hits, qrels, (1, 5)).collect()}
    idcg5 = 2 / math.log2(2) + 1 / math.log2(3)
    assert got[1].ndcg_at_1 == 0.0
    assert abs(got[1].ndcg_at_5 - (1 / math.log2(3)) / idcg5) < 1e-12
    assert got[3].ndcg_at_5 == 0.0      # relevant docs, nothing retrieved
    assert 2 not in got                  # no relevant docs: not scored


def test_macro_average_counts_missing_tasks(spark):
    scores = spark.createDataFrame([("a", "test", "ndcg", 5, 0.5), ("b", "dev", "ndcg", 5, 0.25),
                                    ("b", "test", "ndcg", 5, 0.75)],
                                   "task string, split string, metric string, k int, score double")
    s = rt.macro_average(scores, tasks=["a", "b", "c"]).first()
    assert s.total_tasks == 3 and s.valid_tasks == 2
    assert abs(s.avg_ndcg_at_5 - 0.625) < 1e-12     # b takes its test split first


def test_cosine_equals_dot_on_unit_vectors(spark):
    q, c = fx.retrieval_sets(spark, SF_SMALL)
    a = _hits(rt.retrieve(q, c, 5))
    scaled = c.withColumn("dv", F.transform("dv", lambda x: x * 3.0))
    b = _hits(rt.retrieve(q, scaled, 5, similarity="cosine"))
    assert a.keys() == b.keys()
    assert all(a[k][0] == b[k][0] and abs(a[k][1] - b[k][1]) < 1e-6 for k in a)
