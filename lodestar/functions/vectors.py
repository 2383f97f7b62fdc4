"""Vector column functions over ``array<float|double>`` columns.

Arithmetic runs in double.  Sums are left folds from 0.0, the same order a
SQL ``list_reduce`` uses, so results agree bit for bit with the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0).cast("double"), lambda s, x: s + x)


def to_double(v) -> Column:
    return _c(v).cast("array<double>")


def to_float(v) -> Column:
    """Cast to float32 elements (``astype(np.float32)``)."""
    return _c(v).cast("array<float>")


def truncate_dims(v, k: int) -> Column:
    """Matryoshka prefix: the first ``k`` dimensions."""
    return F.slice(_c(v), 1, k)


def dot(a, b) -> Column:
    return _sum(F.zip_with(to_double(a), to_double(b), lambda x, y: x * y))


def norm(v) -> Column:
    return F.sqrt(_sum(F.transform(to_double(v), lambda x: x * x)))


def per_element(arr: Column, value: Column) -> Column:
    """``value`` repeated to the length of ``arr``: a row-level value evaluated
    once instead of once per element inside a lambda."""
    return F.array_repeat(value, F.size(arr))


def l2_normalize(v) -> Column:
    """``v / ||v||``; a zero vector gives null instead of NaN."""
    return divided(v, norm(v))


def divided(v, n) -> Column:
    """``v / n`` for a norm that is already known; null unless it is positive."""
    d, n = to_double(v), _c(n)
    return F.when(n > 0, F.zip_with(d, per_element(d, n), lambda x, m: x / m))


def dot_logit(a, b, tau: float) -> Column:
    """Scaled dot product ``a·b / tau``."""
    return dot(a, b) / F.lit(float(tau))


def cosine(a, b) -> Column:
    den = norm(a) * norm(b)
    return F.when(den > 0, dot(a, b) / den)


def l1_mean(a, b) -> Column:
    """Mean absolute difference over the elements."""
    d = F.zip_with(to_double(a), to_double(b), lambda x, y: F.abs(x - y))
    return _sum(d) / F.size(_c(a))


def l1_sum(a, b) -> Column:
    return _sum(F.zip_with(to_double(a), to_double(b), lambda x, y: F.abs(x - y)))
