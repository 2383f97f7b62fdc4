"""Query/document pair cleaning: composition, validity, rank and weight."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions import text as T


def valid_pairs(df: DataFrame, left: str = "query", right: str = "positive") -> DataFrame:
    """Keep pairs whose two sides are both non-null and non-empty (Python truthiness)."""
    return df.filter(T.is_truthy(left) & T.is_truthy(right))


def pairs_from_hits(df: DataFrame) -> DataFrame:
    """Index hits (query, title, snippet, rank) to raw pairs (query, positive, rank)."""
    return df.withColumn("positive", T.compose_document("title", "snippet"))
