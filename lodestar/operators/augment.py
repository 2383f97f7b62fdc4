"""Text augmentations, one of eight drawn per line.

Every random choice is ``uniform(seed, salt, keys...)`` of the row's own key,
so a line's augmentation does not depend on partitioning or on which other
rows share its task.  Everything except ``concat_random`` is a column
expression (the two shuffles by Arrow batches); ``concat_random`` needs a partner line and is an
equi-join on a drawn global position.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from lodestar.functions.random import key_text, uniform
from lodestar.functions.text import split_words
from lodestar.operators.order import global_from_group_positions, with_positions
from lodestar.session import ship_package


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def substring_random(line, seed, *keys) -> Column:
    """``line[start:end]`` with start in [0, n-1], end in [start+1, n]; empty stays empty."""
    s = _c(line)
    n = F.length(s)
    start = F.floor(uniform(seed, "sub_start", *keys) * n)
    end = start + 1 + F.floor(uniform(seed, "sub_end", *keys) * (n - start))
    return F.when(n == 0, s).otherwise(s.substr(start + 1, end - start))


def repeat_random(line, seed, *keys) -> Column:
    """The line repeated 1-3 times, no separator."""
    times = (F.lit(1) + F.floor(uniform(seed, "repeat", *keys) * 3)).cast("int")
    return F.repeat(_c(line), times)


def _order(prefix: str, n: int) -> np.ndarray:
    """The seeded random order of n parts.  One md5 of ``prefix|block`` gives the draws of four parts."""
    head = f"{prefix}|".encode()
    draws = b"".join([hashlib.md5(head + b"%d" % b).digest() for b in range(-(-n // 4))])
    return np.argsort(np.frombuffer(draws, ">u4")[:n].astype(np.uint32), kind="stable")


def _mixed_words(text: str, prefix: str) -> str:
    words = text.split(" ") if text else []
    return " ".join([words[k] for k in _order(prefix, len(words)).tolist()])


def _mixed_chars(text: str, prefix: str) -> str:
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return points[_order(prefix, len(points))].tobytes().decode("utf-32-le")


def _shuffled(text: Column, mix, seed, salt: str, keys) -> Column:
    """``mix(text, prefix)`` by Arrow batches, the draws' prefix being ``seed|salt|keys``."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ship_package(active)

    @arrow_udf("string")
    def run(texts: pa.Array, prefixes: pa.Array) -> pa.Array:
        return pa.array([None if t is None else mix(t, p) for t, p in zip(texts.to_pylist(), prefixes.to_pylist())], pa.string())
    return run(text, key_text(seed, salt, *keys))


def shuffle_words(line, seed, *keys) -> Column:
    """Words (Python ``split()``) in a seeded random order, joined by one space."""
    return _shuffled(F.array_join(split_words(_c(line)), " "), _mixed_words, seed, "words", keys)


def shuffle_chars(line, seed, *keys) -> Column:
    """Characters (code points) in a seeded random order."""
    return _shuffled(_c(line), _mixed_chars, seed, "chars", keys)


def reverse_half(line) -> Column:
    """First half kept, second half reversed (``mid = len // 2``)."""
    s = _c(line)
    mid = F.floor(F.length(s) / 2)
    return F.concat(s.substr(F.lit(1), mid), F.reverse(s.substr(mid + 1, F.length(s) + 1)))


def reverse_word(line, seed, *keys) -> Column:
    """Pick a word; replace every occurrence of it (as a substring) by its reverse."""
    s = _c(line)
    pick = uniform(seed, "word", *keys)
    # transform over the one split hands it to a lambda, so that it is made once
    picked = F.transform(F.array(split_words(s)), lambda ws: F.get(ws, F.floor(pick * F.size(ws)).cast("int")))
    out = F.transform(picked, lambda w: F.coalesce(F.replace(s, w, F.reverse(w)), s))
    return F.get(out, 0)


def assign_role(seed, *keys) -> Column:
    """'query' or 'document' with probability 1/2 each."""
    return F.when(uniform(seed, "role", *keys) < 0.5, F.lit("query")).otherwise(F.lit("document"))


def draw_case(seed, *keys, cases: int = 8) -> Column:
    """Augmentation number in 1..cases."""
    return (F.lit(1) + F.floor(uniform(seed, "case", *keys) * cases)).cast("int")


def with_partner(df: DataFrame, line: str, gpos: str, n_rows: int, seed, keys, out: str = "partner",
                 only: Column | None = None) -> DataFrame:
    """Attach a uniformly drawn partner line (may be the row itself) by an
    equi-join on its global position.  ``only`` limits the draw to some rows;
    the other rows bypass the join (a null join key would send all of them to
    one shuffle partition) and are unioned back with a null partner."""
    draw = F.floor(uniform(seed, "other", *keys) * F.lit(n_rows)).cast("bigint")
    right = df.select(F.col(gpos).alias("_other"), F.col(line).alias(out))
    if only is None:
        return df.withColumn("_other", draw).join(right, "_other", "left").drop("_other")
    need = df.filter(only).withColumn("_other", draw).join(right, "_other", "left").drop("_other")
    rest = df.filter(~only | only.isNull()).withColumn(out, F.lit(None).cast("string"))
    return need.unionByName(rest)


def concat_random(df: DataFrame, line: str, seed, keys, order_by=None, out: str = "text",
                  only: Column | None = None, dense_in: tuple[str, str] | None = None) -> DataFrame:
    """``f"{other} {line}"`` or ``f"{line} {other}"`` (50/50) with a random partner line.

    Partners are drawn by global position.  ``dense_in=(group, pos)`` says that
    ``pos`` is already dense within ``group`` (as in versioned line files), so
    the global position comes from per-group counts instead of a global sort.
    """
    order_by = order_by or keys
    n = df.count()
    if dense_in is not None:
        g = global_from_group_positions(df, dense_in[0], dense_in[1], out="_gpos")
    else:
        g = with_positions(df, order_by, pos="_gpos")
    j = with_partner(g, line, "_gpos", n, seed, [F.col(k) if isinstance(k, str) else k for k in keys],
                     out="_partner", only=only)
    first = uniform(seed, "order", *keys) < 0.5
    txt = F.when(first, F.concat(F.col("_partner"), F.lit(" "), F.col(line))).otherwise(
        F.concat(F.col(line), F.lit(" "), F.col("_partner")))
    return j.withColumn(out, txt).drop("_gpos", "_partner")


def augment(df: DataFrame, line: str, seed, keys, order_by=None,
            dense_in: tuple[str, str] | None = None) -> DataFrame:
    """Draw one of eight cases per row and apply it: adds (case, text)."""
    kc = [F.col(k) if isinstance(k, str) else k for k in keys]
    case = draw_case(seed, *kc)
    t = df.withColumn("case", case)
    t = concat_random(t, line, seed, keys, order_by, out="_c4", only=F.col("case") == 4, dense_in=dense_in)
    s = F.col(line)
    text = (F.when(F.col("case") == 1, s)
            .when(F.col("case") == 2, substring_random(s, seed, *kc))
            .when(F.col("case") == 3, repeat_random(s, seed, *kc))
            .when(F.col("case") == 4, F.col("_c4"))
            .when(F.col("case") == 5, shuffle_words(F.when(F.col("case") == 5, s), seed, *kc))
            .when(F.col("case") == 6, shuffle_chars(F.when(F.col("case") == 6, s), seed, *kc))
            .when(F.col("case") == 7, reverse_half(s))
            .otherwise(reverse_word(s, seed, *kc)))
    return t.withColumn("text", text).drop("_c4")
