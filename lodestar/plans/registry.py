"""Registry of named queries: a Spark callable (spark, sf_dir) -> DataFrame and,
where SQL can express it, the DuckDB oracle for the same result.

Output conventions shared by both sides: integer columns are BIGINT, real
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), 6)


def as_long(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("bigint")


def load_all():
    """Import every query module so that they register themselves."""
    from lodestar.plans import (  # noqa: F401
        q_eval, q_vectors, q_text, q_tokens, q_order, q_losses, q_metrics, q_sources, q_streams, q_udf, q_pipelines)
    return QUERIES, ORACLE
