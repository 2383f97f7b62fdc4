"""Quality rules by robust multivariate outliers (operator 6).

``text_stats`` counts words, word characters, symbols, repeated lines and
repeated word runs of each whole text.  ``judge`` turns them into four
transformed statistics

* log of the mean word length,
* asin(sqrt(.)) of the shares of symbols among word characters, of repeated
  lines among lines, and of words in repeated 3-word windows, the last two less what
  the text's length leads to expect,

estimates centre and covariance of each (language, source) by the minimum
covariance determinant and rejects rows whose squared Mahalanobis distance
exceeds a chi-square quantile.

The estimate is distributed: a concentration step is one aggregation.  Rows are
put in narrow bins of their distance under the present estimate, and each
(group, bin) gives counts, sums and cross products (combined on the map side, so
a group with a third of all rows is no single task).  The bins up to the one
that holds the h-th smallest distance make the next estimate.  Steps start from
medians and median deviations; a floor of the size of the rounding on every
variance keeps the determinant positive where a statistic does not vary.

A statistic of a short text is a noisy one: to the covariance of its group each
row adds the sampling variance of its own statistics, cv**2 / words for the log of
a mean length and 1 / (4 trials) for the angle of a share, with the words as trials
of symbols, the lines as those of repeated lines and a sixth of the words (two
windows of three words are the least that repeats) as those of repeated windows.

A long text repeats itself by chance: any two of its windows, or lines, may be equal,
so the expected share is a rate times the length.  The rate is a language's weighted median
of share / length over its rows, long texts weighing by the square of their length, since they alone
tell it.  Rates differ between texts: their spread above the median, on a log scale, adds
to a row's own variance.

Groups of fewer than ``min_rows`` eligible rows are judged together as one
group; if that one is too small, none of its rows is rejected.  Rows that fail
the base rule (under 50 words, or over half of the words in repeated windows)
take no part in the estimates and are not kept.  A null text has no words; null
languages and sources are groups like others.  Repeated rows count each.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import land, map_texts

# Symbols, and ASCII white space other than the line feed.
SYMBOLS, BLANKS = "#*$%&|<>", " \t\r\x0b\x0c"
MIN_WORDS = 50
#: Share of rows that an estimate rests on, steps, smallest group, tail probability beyond which a row is an outlier.
ALPHA, STEPS, MIN_ROWS, TAIL = 0.75, 6, 60, 1e-3
#: Standard deviations below which no statistic goes, some roundings: log length, and three angles.
FLOORS = (0.001, 0.001, 0.001, 0.001)
#: Coefficient of variation of word lengths within a text.
LENGTH_CV = 0.6
BINS_PER_OCTAVE = 8
#: Bin of rows without a repetition, below all others.
_NEVER = -100_000
D = 4
_X = [f"x{i}" for i in range(D)]
_V = [f"v{i}" for i in range(D)]
_PAIRS = [(i, j) for i in range(D) for j in range(i, D)]


def repeat_words(words: list[bytes]) -> int:
    """Words inside a 3-word window that occurs twice or more, first occurrences included."""
    n = len(words)
    if n < 4:
        return 0
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    if len(number) == n:
        return 0
    pair = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
    _, at, times = np.unique(pair[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    start = np.flatnonzero(times[at] > 1)
    hit = np.zeros(n, bool)
    for k in range(3):
        hit[start + k] = True
    return int(hit.sum())


def _stats(texts: list) -> list[pa.Array]:
    rows = []
    for t in texts:
        t = t or ""
        words = t.encode().split()  # of bytes: at ASCII white space only
        lines = [x for x in t.split("\n") if x.strip(BLANKS)]
        rows.append((len(words), len(t) - t.count("\n") - sum(map(t.count, BLANKS)), sum(map(t.count, SYMBOLS)),
                     len(lines) - len(set(lines)), repeat_words(words), len(lines)))
    return [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 6)]


def text_stats(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_lines of each text."""
    return map_texts(docs, text_col, keep, "n_words bigint, word_chars bigint, n_symbols bigint, "
                     "n_dup_lines bigint, n_repeat_words bigint, n_lines bigint", lambda: _stats)


def chi2_cutoff(tail: float, d: int = D) -> float:
    """Where the chi-square distribution of an even number of degrees has ``tail`` beyond."""
    def beyond(x):
        return math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(d // 2))
    lo, hi = 0.0, 1e4
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if beyond(mid) > tail else (lo, mid)
    return hi


def _share(a: str, b: str):
    return F.asin(F.sqrt(F.least(F.lit(1.0), F.col(a) / F.greatest(F.col(b), F.lit(1)))))


_LOWER = [(i, j) for i in range(D) for j in range(i + 1)]
_PARAMS = [f"m{i}" for i in range(D)] + [f"l{i}{j}" for i, j in _LOWER]


def _estimates(sums: DataFrame) -> DataFrame:
    """Row counts, sums and cross products of groups -> centres and Cholesky factors of the covariances."""
    out = sums.select("grp", *[(F.col(f"s{i}") / F.col("n")).alias(f"m{i}") for i in range(D)],
                      *[(F.col(f"q{i}{j}") / F.col("n")).alias(f"q{i}{j}") for i, j in _PAIRS])
    for i, j in _LOWER:
        rest = F.col(f"q{j}{i}") - F.col(f"m{i}") * F.col(f"m{j}")
        if i == j:
            rest = F.greatest(rest, F.lit(0.0)) + FLOORS[i] ** 2
        rest = sum((-F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), rest)
        # the floor keeps pivots positive; the bound only guards against rounding
        out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-9))) if i == j else rest / F.col(f"l{j}{j}"))
    return out.select("grp", *_PARAMS)


def _distance(rows: DataFrame, params: DataFrame, how: str = "left") -> DataFrame:
    """``rows`` with d2; null where the group has no estimate, or without those rows (``how`` inner: a filter
    on d2 would be pushed below and copy every factor many times).  Sampling variances of the rows, if there, count."""
    out = rows.join(params, "grp", how)
    if set(_V) <= set(rows.columns):  # the factor of the group's covariance plus the row's own variances
        for i, j in _LOWER:
            c = sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j + 1)), F.lit(0.0))
            out = out.withColumn(f"c{i}{j}", c + F.col(f"v{i}") if i == j else c)
        out = out.drop(*[f"l{i}{j}" for i, j in _LOWER])
        for i, j in _LOWER:
            rest = sum((-F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.col(f"c{i}{j}"))
            out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-9))) if i == j else rest / F.col(f"l{j}{j}"))
        out = out.drop(*[f"c{i}{j}" for i, j in _LOWER])
    for i in range(D):
        z = F.col(f"x{i}") - F.col(f"m{i}")
        z = sum((-F.col(f"l{i}{k}") * F.col(f"z{k}") for k in range(i)), z)
        out = out.withColumn(f"z{i}", z / F.col(f"l{i}{i}"))
    d2 = sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(D)), F.lit(0.0))
    return out.withColumn("d2", d2).drop(*_PARAMS, *[f"z{i}" for i in range(D)])


def _bins(rows: DataFrame) -> DataFrame:
    """Sums per (group, bin of the distance) with running row counts."""
    width = F.floor(F.log2(F.col("d2") + 2.0 ** -16) * BINS_PER_OCTAVE)
    binned = rows.withColumn("bin", width).groupBy("grp", "bin").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(f"s{i}") for i, x in enumerate(_X)],
        *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q{i}{j}") for i, j in _PAIRS])
    w = Window.partitionBy("grp")  # some hundred bins at most
    return binned.withColumn("upto", F.sum("n").over(w.orderBy("bin"))).withColumn("all", F.sum("n").over(w))


def _chance(rows: DataFrame, count: str, size: str, out: str) -> DataFrame:
    """(tongue, ``out``_rate, ``out``_spread): the share that repeats by chance per unit of length, and its log spread.

    A row's rate is count / size**2; rows weigh size**2.  Rates are put in narrow bins, so the weighted
    quantiles are running sums over some hundred bins of a language, whatever its rows.
    """
    weight = F.pow(F.col(size).cast("double"), F.lit(2.0))
    place = F.when(F.col(count) > 0, F.floor(F.log2(F.col(count) / weight) * BINS_PER_OCTAVE)).otherwise(F.lit(_NEVER))
    w = Window.partitionBy("tongue")
    bins = (rows.filter(F.col(size) > 0).groupBy("tongue", place.alias("bin")).agg(F.sum(weight).alias("w"))
            .withColumn("upto", F.sum("w").over(w.orderBy("bin"))).withColumn("all", F.sum("w").over(w)))
    at = bins.groupBy("tongue").agg(*[F.min(F.when(F.col("upto") >= q * F.col("all"), F.col("bin"))).alias(n)
                                      for n, q in (("mid", 0.5), ("high", 0.84))])
    return at.select("tongue", F.when(F.col("mid") > _NEVER, F.pow(F.lit(2.0), (F.col("mid") + 0.5) / BINS_PER_OCTAVE))
                     .otherwise(0.0).alias(f"{out}_rate"),
                     ((F.col("high") - F.col("mid")) * math.log(2) / BINS_PER_OCTAVE).alias(f"{out}_spread"))


def _expected(rate: str, spread: str, size: str):
    """The angle that chance leads to expect at a length, and the variance that differing rates give it."""
    angle = F.asin(F.sqrt(F.least(F.lit(0.5), F.coalesce(F.col(rate), F.lit(0.0)) * F.col(size))))
    return angle, F.pow(0.5 * angle * F.coalesce(F.col(spread), F.lit(0.0)), F.lit(2.0))


def judge(stats: DataFrame, lang_col: str = "lang", source_col: str = "source", alpha: float = ALPHA,
          steps: int = STEPS, min_rows: int = MIN_ROWS, tail: float = TAIL) -> DataFrame:
    """Add base_failed, distance (null where not estimated) and kept to a table of ``text_stats``."""
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    null = F.lit("\u0000")
    x = [F.log(F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1)) + 1e-9),
         _share("n_symbols", "word_chars"), _share("n_dup_lines", "n_lines"), _share("n_repeat_words", "n_words")]
    # a row that the base rule lets through has words; lines are at least one
    words = F.greatest(F.col("n_words"), F.lit(1))
    noise = [LENGTH_CV ** 2 / words, 0.25 / words, 0.25 / F.greatest(F.col("n_lines"), F.lit(1)), 1.5 / words]
    cols = stats.columns
    tongue = F.coalesce(F.col(f"`{lang_col}`").cast("string"), null)
    rows = land(stats.select(
        *[F.col(f"`{c}`").alias(f"c_{i}") for i, c in enumerate(cols)], base.alias("base_failed"),
        F.to_json(F.array(tongue, F.coalesce(F.col(f"`{source_col}`").cast("string"), null))).alias("own"),
        tongue.alias("tongue"), F.col("n_lines").alias("lines"), F.col("n_words").alias("words"),
        F.col("n_dup_lines").alias("again_lines"), F.col("n_repeat_words").alias("again_words"),
        *[c.alias(n) for c, n in zip(x, _X)], *[c.alias(n) for c, n in zip(noise, _V)]), "outlier-stats")
    good = rows.filter(~F.col("base_failed"))
    for k, size, count in ((2, "lines", "again_lines"), (3, "words", "again_words")):
        rows = rows.join(land(_chance(good, count, size, size), f"outlier-chance-{size}"), "tongue", "left")
        angle, spread = _expected(f"{size}_rate", f"{size}_spread", size)
        rows = rows.withColumn(_V[k], F.col(_V[k]) + spread).withColumn(_X[k], F.col(_X[k]) - angle)
    rows = land(rows.select(*[f"c_{i}" for i in range(len(cols))], "base_failed", "own",
                            *[F.round(x, 4).alias(x) for x in _X], *_V), "outlier-rows")
    good = rows.filter(~F.col("base_failed"))
    sizes = good.groupBy("own").count()
    own = sizes.filter(F.col("count") >= min_rows).select("own", F.col("own").alias("grp"))
    rows = rows.join(land(own, "outlier-groups"), "own", "left").withColumn("grp", F.coalesce("grp", F.lit("(rest)")))
    good = rows.filter(~F.col("base_failed")).select("grp", *_X, *_V)
    enough = good.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), *[
        F.percentile(F.round(c, 2), 0.5).alias(f"med{i}") for i, c in enumerate(_X)]).filter(F.col("n") >= min_rows)
    # rounding bounds the number of different values that an exact percentile keeps
    mad = (good.join(enough, "grp").groupBy("grp", *[f"med{i}" for i in range(D)]).agg(*[
        F.percentile(F.round(F.abs(F.col(c) - F.col(f"med{i}")), 2), 0.5).alias(f"mad{i}") for i, c in enumerate(_X)]))
    params = land(mad.select("grp", *[F.col(f"med{i}").alias(f"m{i}") for i in range(D)], *[
        (F.lit(0.0) if i != j else F.sqrt(F.pow(1.4826 * F.col(f"mad{i}"), F.lit(2.0)) + FLOORS[i] ** 2)
         ).alias(f"l{i}{j}") for i, j in _LOWER]), "outlier-start")
    for k in range(steps):
        near = _bins(_distance(good, params, "inner")).filter(
            F.col("upto") - F.col("n") < F.ceil(alpha * F.col("all")))
        sums = near.groupBy("grp").agg(F.sum("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(D)],
                                       *[F.sum(f"q{i}{j}").alias(f"q{i}{j}") for i, j in _PAIRS])
        params = land(_estimates(sums), f"outlier-step{k}")
    # the half-way distance against that of a chi-square: trimmed covariances are too small
    half = _bins(_distance(good, params, "inner")).filter(
        F.col("upto") >= 0.5 * F.col("all")).groupBy("grp").agg(F.min("bin").alias("bin"))
    scale = half.select("grp", F.greatest(F.lit(1.0), F.pow(F.lit(2.0), (F.col("bin") + 1) / BINS_PER_OCTAVE)
                                          / chi2_cutoff(0.5)).alias("scale"))
    cut = chi2_cutoff(tail)
    out = _distance(rows, params).join(land(scale, "outlier-scale"), "grp", "left").withColumn(
        "distance", F.when(~F.col("base_failed"), F.sqrt(F.col("d2") / F.col("scale"))))
    return out.select(*[F.col(f"c_{i}").alias(c) for i, c in enumerate(cols)], "base_failed", "distance",
                      (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= math.sqrt(cut))).alias("kept"))
