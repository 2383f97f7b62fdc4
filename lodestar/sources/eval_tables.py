"""Evaluation-set source: queries, corpus and relevance judgments per task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def load_eval(*tables: DataFrame, tasks=None):
    """Restrict evaluation tables (queries, corpus and, where they are listed, judged pairs) to
    ``tasks`` (all tasks when None).

    The task list is a small literal, so the filter is pushed into each scan.
    """
    if tasks is None:
        return tables
    t = [F.lit(x) for x in tasks]
    return tuple(df.filter(F.col("task").isin(*t)) for df in tables)
