"""Evaluation from text to scores: encode both sides, retrieve, judge, average over the tasks asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.operators.encode import DrawEncoder, encode_texts
from lodestar.operators.retrieval import macro_average, ndcg, retrieve, task_scores
from lodestar.sources.eval_tables import load_eval

KS = (1, 5, 10)


def encode_side(df: DataFrame, role: str, encoder_factory, out: str, task_name: str | None = None,
                max_length: int | None = None, batch_size: int = 64) -> DataFrame:
    """Vectors of one side as an evaluation takes them: EOS pooling, normalised, ``batch_size`` texts at a time.

    ``role`` is query or document; with ``task_name`` only that task's rows are encoded.  A limit of
    ``max_length`` tokens keeps the closing token.  Rows with a null text are encoded as the empty text.
    """
    rows = df if task_name is None else df.filter(F.col("task") == task_name)
    filled = rows.withColumn("text", F.coalesce("text", F.lit("")))
    return encode_texts(filled, "text", F.lit(role), encoder_factory, pooling="eos", max_length=max_length,
                        batch_size=batch_size, out=out, element="double").drop("text")


def evaluate_texts(queries: DataFrame, corpus: DataFrame, judgments: DataFrame, tasks, encoder_factory=None,
                   ks=KS, max_length: int | None = None, batch_size: int = 64, metric_k: int = 5) -> tuple[DataFrame, DataFrame]:
    """(summary, scores) of the tasks asked for.

    queries (task, qid, text), corpus (task, did, text), judgments (task, qid, did, rel).  ``scores`` is
    (task, split, metric, k, score); ``summary`` has one row with the scores by task, their
    mean over the tasks that have one, and how many were asked for and had one.
    """
    factory = encoder_factory or DrawEncoder.factory()
    queries, corpus, judgments = load_eval(queries, corpus, judgments, tasks=tasks)
    q = encode_side(queries, "query", factory, "qv", max_length=max_length, batch_size=batch_size)
    d = encode_side(corpus, "document", factory, "dv", max_length=max_length, batch_size=batch_size)
    hits = retrieve(q, d, k=max(ks), decimals=9)
    scores = task_scores(ndcg(hits, judgments, ks))
    return macro_average(scores, tasks=tasks, metric="ndcg", k=metric_k), scores
