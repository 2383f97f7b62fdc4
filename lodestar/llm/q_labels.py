"""op11: quality of the documents table."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.llm import pu_quality
from lodestar.llm.common import fold_of, read_table
from lodestar.llm.registry import query

#: Score from which a document counts as good.
GOOD = 0.7


@query("op11_quality_classifier")
def op11_quality_classifier(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    held_out = fold_of("doc_id", 4) == 2
    net = pu_quality.fit(docs, read_table(spark, sf_dir, "labels"), ~held_out)
    return pu_quality.score(docs, net, ["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))
