"""op3: language of every document."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.llm import byte_cnn
from lodestar.llm.common import fold_of, read_table
from lodestar.llm.registry import query


@query("op3_language_id")
def op3_language_id(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    held_out = fold_of("doc_id", 3) == 1
    net = byte_cnn.fit(docs, ~held_out)
    return byte_cnn.predict(docs, net, keep=["doc_id"]).select("doc_id", held_out.alias("held_out"),
                                                               "lang_pred", "score")
