"""Deterministic, partition-independent pseudo-random numbers.

``uniform(seed, salt, key...)`` is a value in [0, 1) computed from the md5 of
``seed|salt|key``.  Unlike ``rand(seed)`` it does not depend on how rows are
split into partitions, so a re-run after an executor loss or with a different
number of partitions yields the same draw for the same row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_32 = 4294967296.0


def _key_cols(keys) -> list[Column]:
    out = []
    for k in keys:
        c = F.col(k) if isinstance(k, str) else k
        out.append(c.cast("string"))
    return out


def key_text(seed, salt: str, *keys) -> Column:
    """``seed|salt|keys...``; null keys are left out."""
    seed_c = seed.cast("string") if isinstance(seed, Column) else F.lit(str(seed))
    return F.concat_ws("|", seed_c, F.lit(salt), *_key_cols(keys))


def hash_key(seed, salt: str, *keys) -> Column:
    """md5 hex string of ``seed|salt|keys...`` — a uniform sort key."""
    return F.md5(key_text(seed, salt, *keys))


def uniform(seed, salt: str, *keys) -> Column:
    """Uniform double in [0, 1) from the first 32 bits of ``hash_key``."""
    h = hash_key(seed, salt, *keys)
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") / F.lit(_TWO_32)


def randint(seed, salt: str, lo: Column | int, hi: Column | int, *keys) -> Column:
    """Integer uniform in [lo, hi] inclusive (Python ``random.randint``)."""
    lo_c = lo if isinstance(lo, Column) else F.lit(lo)
    hi_c = hi if isinstance(hi, Column) else F.lit(hi)
    span = (hi_c - lo_c + 1).cast("double")
    return (lo_c + F.floor(uniform(seed, salt, *keys) * span)).cast("bigint")
