"""op9: language-model scores of the documents table."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.llm import logbilinear
from lodestar.llm.common import fold_of, read_table
from lodestar.llm.registry import query


@query("op9_lm_score")
def op9_lm_score(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold_of("doc_id", 5) == 1
    model = logbilinear.fit(docs, ~held_out)
    out = logbilinear.score(docs, model, ["doc_id"])
    return out.withColumn("held_out", held_out).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
