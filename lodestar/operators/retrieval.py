"""Exact top-k retrieval and ranking metrics (NDCG, precision, recall, MAP, MRR).

Schemas
-------
queries: (task, qid, qv array)   corpus: (task, did, dv array)
qrels:   (task, qid, did, rel)   hits:   (task, qid, did, score, rank)

Queries and corpus of a task are dealt into tiles by hash of qid and did, as many
as TILE_BYTES of vectors ask for.  Every pair of tiles is one cogroup: a matrix product
in blocks, which keeps the k best of each query as it goes, so a tile pair hands on
k rows per query and no scored pair is sorted or stored.  One merge by query ends
it.  Tile counts are computed inside the plan; no query row reaches the driver, and neither
side need fit anywhere as a whole.
Candidates are chosen a hair below the k-th score and scored again as left
folds, so results do not depend on how a matrix product adds up.

Judgments come as a table of pairs, or as classes (``ClassJudgments``): then a hit is relevant if its
document has the query's class, and the pairs, whose number grows with the square of a class,
are never listed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions.vectors import l2_normalize
from lodestar.session import ship_package

HITS_SCHEMA = "task string, qid long, did long, score double"
#: Bytes of vectors in a tile of either side, and entries of a block of scores.
TILE_BYTES, BLOCK = 32 << 20, 1 << 21


def _rank_top_k(scored: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("task", "qid").orderBy(F.col("score").desc(), F.col("did").asc())
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _tiles(queries: DataFrame, corpus: DataFrame, tile_bytes: int) -> DataFrame:
    """(task, _nq, _nd): tiles of each side, for tasks that have queries and documents."""
    q = queries.groupBy("task").agg(F.count(F.lit(1)).alias("q"), F.max(F.size("qv")).alias("w"))
    d = corpus.groupBy("task").agg(F.count(F.lit(1)).alias("d"))
    rows = F.greatest(F.lit(1), F.floor(F.lit(tile_bytes) / (8 * F.greatest(F.col("w"), F.lit(1)))))
    return q.join(d, "task").select("task", *[F.ceil(F.col(c) / rows).cast("int").alias(n)
                                              for c, n in (("q", "_nq"), ("d", "_nd"))])


def retrieve(queries: DataFrame, corpus: DataFrame, k: int = 10, similarity: str = "dot",
             tile_bytes: int = TILE_BYTES, decimals: int | None = None) -> DataFrame:
    """Top-k corpus documents per query by dot product, or by cosine with
    ``similarity="cosine"`` (both sides L2-normalised first, once per vector).

    Ties are broken by ascending ``did``.  Returns (task, qid, did, score, rank).
    With ``decimals`` scores are rounded before they are compared, so that vectors which differ in their
    last bits only tie.
    """
    if similarity == "cosine":
        queries = queries.withColumn("qv", l2_normalize("qv"))
        corpus = corpus.withColumn("dv", l2_normalize("dv"))
    elif similarity != "dot":
        raise ValueError(f"unknown similarity {similarity}")
    ship_package(queries.sparkSession)
    tiles = _tiles(queries, corpus, tile_bytes)  # one row per task
    keys = ["task", "_q", "_d"]

    def dealt(df, own, vec, mine, other):
        """Each row in its own tile of this side, once for every tile of the other."""
        t = df.select("task", F.col(own).cast("long").alias(own), F.col(vec).cast("array<double>").alias(vec)).join(tiles, "task")
        at = F.pmod(F.xxhash64(own), F.col(f"_n{mine}")).cast("int")
        t = t.withColumn(f"_{mine}", at).withColumn(f"_{other}", F.explode(F.sequence(F.lit(0), F.col(f"_n{other}") - 1)))
        # both sides hold columns of the tile table: new names' identities keep them apart in the cogroup
        return t.select(*[F.col(c).alias(c) for c in (*keys, own, vec)])

    q, d = dealt(queries, "qid", "qv", "q", "d"), dealt(corpus, "did", "dv", "d", "q")
    found = q.groupBy(*keys).cogroup(d.groupBy(*keys)).applyInArrow(_tile_scorer(k, decimals), HITS_SCHEMA)
    return _rank_top_k(found, k)


def _matrix(table: pa.Table, col: str) -> np.ndarray:
    """A list column as a matrix."""
    flat = table.column(col).combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def _best(row, did, score, k):
    """The k best of each row, ties to the smaller did."""
    order = np.lexsort((did, -score, row))
    row, did, score = row[order], did[order], score[order]
    first = np.searchsorted(row, row, side="left")
    keep = np.arange(len(row)) - first < k
    return row[keep], did[keep], score[keep]


def _tile_scorer(k: int, decimals: int | None):
    names = ["task", "qid", "did", "score"]
    slack = 1e-9 if decimals is None else max(1e-9, 2 * 10.0 ** -decimals)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({n: pa.array([], t) for n, t in zip(
                names, (pa.string(), pa.int64(), pa.int64(), pa.float64()))})
        q, c = _matrix(left, "qv"), _matrix(right, "dv")
        dids = right.column("did").to_numpy()
        held = None
        step = max(1, BLOCK // len(q))
        for a in range(0, len(c), step):
            s = q @ c[a:a + step].T
            kk = min(k, s.shape[1])
            low = np.partition(s, -kk, axis=1)[:, -kk]
            r, j = np.nonzero(s >= (low - slack * (1 + np.abs(low)))[:, None])
            new = [] if held is None else [held]
            for b in range(0, len(r), 1 << 15):
                rb, jb = r[b:b + (1 << 15)], j[b:b + (1 << 15)] + a
                exact = np.cumsum(q[rb] * c[jb], axis=1)[:, -1]
                new.append((rb, dids[jb], exact if decimals is None else np.round(exact, decimals)))
            held = _best(*(np.concatenate(x) for x in zip(*new)), k)
        row, did, best = held
        return pa.table([pa.array([left.column("task")[0].as_py()] * len(row), pa.string()),
                         left.column("qid").combine_chunks().take(pa.array(row)).cast(pa.int64()),
                         pa.array(did, pa.int64()), pa.array(best, pa.float64())], names=names)
    return score


# ---------------------------------------------------------------------------
# Metrics
# ---------------------------------------------------------------------------

class PairJudgments:
    """Relevance as a table (task, qid, did, rel)."""

    def __init__(self, qrels: DataFrame):
        self.qrels = qrels.select("task", "qid", "did", F.col("rel").cast("double").alias("rel"))

    def judge(self, hits: DataFrame) -> DataFrame:
        """Hits with their relevance."""
        return hits.join(self.qrels, ["task", "qid", "did"], "left").withColumn("rel", F.coalesce("rel", F.lit(0.0)))

    def ideal(self, kmax: int) -> DataFrame:
        """(task, qid, _i, rel): the best possible order's first ``kmax`` relevances."""
        w = Window.partitionBy("task", "qid").orderBy(F.col("rel").desc(), F.col("did").asc())
        return self.qrels.filter(F.col("rel") > 0).withColumn("_i", F.row_number().over(w)).filter(F.col("_i") <= kmax)

    def relevant(self) -> DataFrame:
        """(task, qid, _R): relevant documents of each query that has one."""
        return self.qrels.filter(F.col("rel") > 0).groupBy("task", "qid").agg(F.count(F.lit(1)).alias("_R"))


class ClassJudgments:
    """Relevance by class: (task, qid, class) and (task, did, class); a document of the query's class has relevance 1.

    Equal to the table of all pairs of a class, which is not made: hits look their two classes up,
    and a query's relevant documents are counted per class.
    """

    def __init__(self, queries: DataFrame, documents: DataFrame, of: str = "class"):
        self.q = queries.select("task", "qid", F.col(of).alias("_qc"))
        self.d = documents.select("task", "did", F.col(of).alias("_dc"))

    def judge(self, hits: DataFrame) -> DataFrame:
        both = hits.join(self.q, ["task", "qid"], "left").join(self.d, ["task", "did"], "left")
        return both.withColumn("rel", F.when(F.col("_qc") == F.col("_dc"), 1.0).otherwise(0.0)).drop("_qc", "_dc")

    def ideal(self, kmax: int) -> DataFrame:
        n = F.least(F.col("_R"), F.lit(kmax)).cast("int")
        return self.relevant().select("task", "qid", F.explode(F.sequence(F.lit(1), n)).alias("_i"), F.lit(1.0).alias("rel"))

    def relevant(self) -> DataFrame:
        n = self.d.groupBy("task", F.col("_dc").alias("_qc")).agg(F.count(F.lit(1)).alias("_R"))
        return self.q.join(n, ["task", "_qc"]).drop("_qc")

    def count_by_task(self) -> DataFrame:
        """(task, n): judgments that the classes stand for."""
        return self.relevant().groupBy("task").agg(F.sum("_R").alias("n"))


def _judgments(j):
    return PairJudgments(j) if isinstance(j, DataFrame) else j


def _judged_hits(hits: DataFrame, judgments, kmax: int) -> DataFrame:
    return judgments.judge(hits.filter(F.col("rank") <= kmax).select("task", "qid", "did", "rank"))


def _discount(rank_col) -> F.Column:
    return F.lit(1.0) / F.log2(rank_col.cast("double") + F.lit(1.0))


def ndcg(hits: DataFrame, qrels, ks=(1, 5, 10)) -> DataFrame:
    """Per-query NDCG@k with linear gain; queries without a relevant doc are skipped.

    ``qrels``: a table of judged pairs or ``ClassJudgments``.  Returns (task, qid, ndcg_at_<k>...).
    """
    kmax, judgments = max(ks), _judgments(qrels)
    h = _judged_hits(hits, judgments, kmax)

    def gain(at, k):
        return F.sum(F.when(F.col(at) <= k, F.col("rel") * _discount(F.col(at))).otherwise(0.0))

    dcg = h.groupBy("task", "qid").agg(*[gain("rank", k).alias(f"_dcg{k}") for k in ks])
    ideal = judgments.ideal(kmax).groupBy("task", "qid").agg(*[gain("_i", k).alias(f"_idcg{k}") for k in ks])
    out = ideal.join(dcg, ["task", "qid"], "left")
    return out.select("task", "qid", *[
        F.try_divide(F.coalesce(F.col(f"_dcg{k}"), F.lit(0.0)), F.col(f"_idcg{k}")).alias(f"ndcg_at_{k}")
        for k in ks])


def rank_metrics(hits: DataFrame, qrels, ks=(1, 5, 10)) -> DataFrame:
    """Per-query precision, recall, MAP and MRR at each k.

    precision@k = relevant in top k / k; recall@k = relevant in top k / R;
    MRR@k = 1 / rank of the first relevant hit within k (else 0);
    MAP@k = sum over relevant hits at rank r <= k of precision@r, divided by R.
    Only queries with R >= 1 relevant documents are scored.
    """
    kmax, judgments = max(ks), _judgments(qrels)
    h = _judged_hits(hits, judgments, kmax).withColumn("_isrel", (F.col("rel") > 0).cast("int"))
    w = Window.partitionBy("task", "qid").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    h = h.withColumn("_cum", F.sum("_isrel").over(w))
    aggs = []
    for k in ks:
        in_k = F.col("rank") <= k
        aggs += [
            F.sum(F.when(in_k, F.col("_isrel")).otherwise(0)).alias(f"_hit{k}"),
            F.max(F.when(in_k & (F.col("_isrel") == 1), F.lit(1.0) / F.col("rank"))).alias(f"_rr{k}"),
            F.sum(F.when(in_k & (F.col("_isrel") == 1), F.col("_cum") / F.col("rank"))).alias(f"_ap{k}"),
        ]
    per = h.groupBy("task", "qid").agg(*aggs)
    out = judgments.relevant().join(per, ["task", "qid"], "left")
    cols = []
    for k in ks:
        hit = F.coalesce(F.col(f"_hit{k}"), F.lit(0)).cast("double")
        cols += [
            (hit / F.lit(float(k))).alias(f"precision_at_{k}"),
            (hit / F.col("_R")).alias(f"recall_at_{k}"),
            (F.coalesce(F.col(f"_ap{k}"), F.lit(0.0)) / F.col("_R")).alias(f"map_at_{k}"),
            F.coalesce(F.col(f"_rr{k}"), F.lit(0.0)).alias(f"mrr_at_{k}"),
        ]
    return out.select("task", "qid", *cols)


def task_scores(per_query: DataFrame, split: str = "test") -> DataFrame:
    """Average per-query metrics by task into the tall form (task, split, metric, k, score)."""
    metric_cols = [c for c in per_query.columns if "_at_" in c]
    avg = per_query.groupBy("task").agg(*[F.avg(c).alias(c) for c in metric_cols])
    stack = ", ".join(f"'{c.rsplit('_at_', 1)[0]}', {int(c.rsplit('_at_', 1)[1])}, `{c}`" for c in metric_cols)
    return avg.select("task", F.lit(split).alias("split"),
                      F.expr(f"stack({len(metric_cols)}, {stack}) as (metric, k, score)"))


def macro_average(scores: DataFrame, tasks=None, metric: str = "ndcg", k: int = 5,
                  split_order=("test", "dev", "validation", "train")) -> DataFrame:
    """Summary over tasks: per-task score (first split holding the metric wins),
    their mean (0.0 when none is valid), requested and valid task counts."""
    spark = scores.sparkSession
    order = F.coalesce(F.array_position(F.array(*[F.lit(s) for s in split_order]), F.col("split")),
                       F.lit(len(split_order) + 1))
    per_task = (scores.filter((F.col("metric") == metric) & (F.col("k") == k) & F.col("score").isNotNull())
                .groupBy("task").agg(F.min_by("score", F.struct(order, F.col("split"))).alias("score")))
    if tasks is None:
        requested = scores.select("task").distinct()
    else:
        requested = spark.createDataFrame([(t,) for t in tasks], "task string")
    joined = requested.join(per_task, "task", "left")
    name = f"{metric}_at_{k}"
    return joined.agg(
        F.map_from_entries(F.sort_array(F.collect_list(
            F.when(F.col("score").isNotNull(), F.struct("task", "score"))))).alias(f"{name}_by_task"),
        F.coalesce(F.avg("score"), F.lit(0.0)).alias(f"avg_{name}"),
        F.count(F.lit(1)).alias("total_tasks"),
        F.count("score").alias("valid_tasks"),
    )
