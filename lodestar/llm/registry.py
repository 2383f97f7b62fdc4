"""Registered queries of this subpackage and their DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

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


def load_all():
    from lodestar.llm import (q_conversations, q_decontam, q_divergence, q_labels, q_language, q_neardup, q_quality,  # noqa: F401
                              q_scoring, q_secrets, q_tokenize, q_warc)
    return QUERIES, ORACLE
