"""op6: quality verdicts of the documents table."""

from __future__ import annotations

from lodestar.llm import outliers
from lodestar.llm.common import read_table
from lodestar.llm.registry import query


@query("op6_quality_outliers")
def op6_quality_outliers(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    stats = outliers.text_stats(docs, ["doc_id", "lang", "source"])
    return outliers.judge(stats).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                        "n_repeat_words", "base_failed", "kept", "distance")
