"""Spark-native data engine for text-embedding and retrieval workloads.

Every operator is a function from DataFrame(s) to a DataFrame, written with
built-in Spark SQL expressions.  Python only appears where a user plugs in a
tokenizer or encoder (Arrow-batched pandas UDFs), in one grouped packer
(token-budget batching) and in one block scorer (numpy matmul per partition).
"""

from lodestar.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
