"""Relevance judgments from texts: a document is relevant to a query whose passage it contains.

Words are those of the lower-cased text.  A passage is ``width`` consecutive words of the query's text; a
shorter text, if it has a word, is one passage.  Queries' and documents' passages meet by a
64-bit hash, in an equi-join whose document side is (document, hash) only, and every pair
that meets is verified on the words before it counts.  The table grows with the copies
of passages, not with the square of anything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.text import split_words

WIDTH = 10


def _words(text: str) -> Column:
    return split_words(F.lower(F.coalesce(F.col(text), F.lit(""))))


def _passages(words: Column, width) -> Column:
    """(length, words) of all windows of ``width`` words, or of the whole text if it is shorter."""
    n = F.least(F.size(words), F.lit(width))
    starts = F.sequence(F.lit(1), F.size(words) - n + 1)
    return F.when(n > 0, F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " ")))


def by_passage(queries: DataFrame, documents: DataFrame, width: int = WIDTH, text: str = "text") -> DataFrame:
    """(task, qid, did, rel 1) for queries (task, qid, text) and documents (task, did, text)."""
    q = (queries.select("task", "qid", _words(text).alias("_w"))
         .select("task", "qid", F.explode(_passages(F.col("_w"), width)).alias("passage"))
         .withColumn("_h", F.xxhash64("passage")).withColumn("_n", F.size(F.split("passage", " "))).distinct())
    # lengths other than the full width come from short queries; documents give windows of the lengths in use
    lengths = q.select("task", "_n").distinct()
    d = documents.select("task", "did", _words(text).alias("_w"))
    windows = F.transform(F.sequence(F.lit(1), F.size("_w") - F.col("_n") + 1),
                          lambda i: F.xxhash64(F.array_join(F.slice("_w", i, F.col("_n")), " ")))
    found = (d.join(lengths, "task").filter(F.size("_w") >= F.col("_n"))
             .select("task", "did", "_n", F.explode(F.array_distinct(windows)).alias("_h"))
             .join(q, ["task", "_n", "_h"]).select("task", "did", "qid", "passage"))
    spaced = F.concat(F.lit(" "), F.array_join("_w", " "), F.lit(" "))
    sure = found.join(d, ["task", "did"]).filter(F.contains(spaced, F.concat(F.lit(" "), F.col("passage"), F.lit(" "))))
    return sure.select("task", "qid", "did", F.lit(1).alias("rel")).distinct()
