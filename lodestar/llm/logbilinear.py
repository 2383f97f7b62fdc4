"""Language-model scores of whole texts by a log-bilinear class model (operator 9).

Words are grouped in classes: the ``TOP`` most frequent training words and the
end of a text are classes of their own, every other word belongs to one of
``TAIL`` classes by its last two characters.  A word's probability is that of
its class given the classes of the two tokens before it, times the word's share
in its class (counts plus a half, with room for one unknown word).

The class model is log-bilinear: the representations of the context classes,
each through its position's matrix, predict that of the next class.  It is
trained in numpy with noise-contrastive estimation on the class trigram counts
of *all* training tokens (at most CLASSES**3 counts): every counted trigram enters
every step by its count, and the noise by its expectation.  Scoring turns batched
matrix products over contexts into normalised log-probabilities.

Counts of all distinct words stay a table.  The ``HOT`` most frequent words of up
to ``HOT_BYTES`` bytes travel to the tasks (a few MB whatever the corpus); rarer
words of a text are joined to the counts by word, so no frequent word crosses
the network once per occurrence.

Defined cases: a null text is the empty text, one end token; repeated rows count
and are scored each; without training rows every base term is 0 and classes are
equally likely.  Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass
from math import log10

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import land, map_texts, text_slices

TOP, TAIL = 95, 32
END = TOP  # class of the end of a text, and the context before its first words
CLASSES = TOP + 1 + TAIL
HOT, HOT_BYTES = 100_000, 64
DIM, NOISE, STEPS, RATE = 24, 10, 500, 0.02
BLOCK = 2048  # contexts whose scores are in memory at once
_FLUSH = 500_000


def tokens_of(text: str | None) -> list[bytes]:
    """Words, A-Z lower-cased; of bytes, so only ASCII letters and ASCII white space count."""
    return (text or "").encode().lower().split()


def tail_class(word: str) -> int:
    return TOP + 1 + zlib.crc32(word[-2:].encode()) % TAIL


def _tail_class(word: Column) -> Column:
    return F.lit(TOP + 1) + F.crc32(F.substring(word, -2, 2).cast("binary")) % TAIL


class LogBilinear:
    """s(w | u, v) = (r_u C_1 + r_v C_2) . r_w + b_w, normalised over all classes."""

    def __init__(self, n: int = CLASSES, dim: int = DIM, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.p = {"r": rng.normal(0, 0.3, (n, dim)), "c1": np.eye(dim) * 0.5, "c2": np.eye(dim),
                  "b": np.zeros(n)}
        self.n = n

    def train(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Noise-contrastive estimation against the unigram class distribution (Adam).

        Nothing is drawn: each step's gradient sums over every counted trigram, and over every
        class as noise of each counted context, in blocks of contexts.
        """
        n, p = self.n, self.p
        total = counts.sum()
        unigram = np.bincount(keys % n, weights=counts, minlength=n) + 1.0
        noise = unigram / unigram.sum()
        p["b"] = np.log(noise)
        shift = np.log(NOISE * noise)
        contexts, row = np.unique(keys // n, return_inverse=True)
        data = np.bincount(row * n + keys % n, weights=counts, minlength=len(contexts) * n).reshape(-1, n) / total
        size = data.sum(1)
        m, v = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
        for step in range(1, STEPS + 1):
            g = {k: np.zeros_like(a) for k, a in p.items()}
            first, second = p["r"] @ p["c1"], p["r"] @ p["c2"]  # what a class adds as the earlier, the later context
            by_first, by_second = np.zeros_like(first), np.zeros_like(second)
            for a in range(0, len(contexts), BLOCK):
                w1, w2 = contexts[a:a + BLOCK] // n, contexts[a:a + BLOCK] % n
                q = first[w1] + second[w2]
                s = q @ p["r"].T + (p["b"] - shift)
                is_data = 1 / (1 + np.exp(-np.clip(s, -30, 30)))  # the probability of being data
                d = is_data * (data[a:a + BLOCK] + size[a:a + BLOCK, None] * (NOISE * noise)) - data[a:a + BLOCK]
                dq = d @ p["r"]
                g["r"] += d.T @ q
                g["b"] += d.sum(0)
                np.add.at(by_first, w1, dq)
                np.add.at(by_second, w2, dq)
            g["c1"], g["c2"] = p["r"].T @ by_first, p["r"].T @ by_second
            g["r"] += by_first @ p["c1"].T + by_second @ p["c2"].T
            rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
            for k in p:
                m[k] += 0.1 * (g[k] - m[k])
                v[k] += 0.001 * (g[k] ** 2 - v[k])
                p[k] = p[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)

    def log10_table(self) -> np.ndarray:
        """log10 P(class | two classes before), shape (n * n, n): one matrix product per first class."""
        n, p = self.n, self.p
        out = np.empty((n * n, n))
        second = p["r"] @ p["c2"]
        for u in range(n):
            s = (p["r"][u] @ p["c1"] + second) @ p["r"].T + p["b"]
            s -= s.max(1, keepdims=True)
            out[u * n:(u + 1) * n] = (s - np.log(np.exp(s).sum(1, keepdims=True))) / np.log(10)
        return out


@dataclass
class Model:
    counts: DataFrame     # (word, n); '' is the end of a text
    net: LogBilinear
    top: list             # words that are classes
    hot: list             # (word, n)
    n: int                # training tokens
    v: int                # distinct training tokens
    class_n: np.ndarray   # tokens and distinct words of each tail class
    class_v: np.ndarray

    def base(self, c):
        return log10((c + 0.5) / (self.n + 0.5 * (self.v + 1)))


def _count_words(batches):
    total = Counter()

    def out():
        return pa.RecordBatch.from_arrays(
            [pa.array([w.decode() for w in total], pa.string()), pa.array(list(total.values()), pa.int64())],
            ["word", "n"])
    for batch in batches:
        for _, texts in text_slices(batch, "text"):
            for t in texts:
                total.update(tokens_of(t))
            total[b""] += len(texts)  # ends
            if len(total) > _FLUSH:
                yield out()
                total = Counter()
    if total:
        yield out()


class _Classes(dict):
    """word -> class, filled as words turn up; bounded."""

    def __missing__(self, word):
        c = tail_class(word.decode())
        if len(self) < 400_000:
            self[word] = c
        return c


def _count_trigrams(top):
    def run(batches):
        known = _Classes({w.encode(): k for k, w in enumerate(top.value)})
        total = np.zeros(CLASSES ** 3, np.int64)
        for batch in batches:
            for _, texts in text_slices(batch, "text"):
                for t in texts:
                    c = np.array([END, END, *map(known.__getitem__, tokens_of(t)), END], np.int64)
                    key, n = np.unique((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], return_counts=True)
                    total[key] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["k", "n"])
    return run


def fit(docs: DataFrame, training: Column, text_col: str = "text") -> Model:
    """Counts and class model of the rows for which ``training`` holds."""
    spark = docs.sparkSession
    texts = docs.filter(training).select(F.col(text_col).cast("string").alias("text"))
    counts = land(texts.mapInArrow(_count_words, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")),
                  "word-counts")
    words = counts.filter(F.col("word") != "")
    hot = [(r["word"], r["n"]) for r in words.filter(F.octet_length("word") <= HOT_BYTES)
           .orderBy(F.desc("n"), "word").limit(HOT).collect()]
    top = [w for w, _ in hot[:TOP]]
    size = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    class_n, class_v = np.zeros(CLASSES), np.zeros(CLASSES)
    tail = words.filter(~F.col("word").isin(top)) if top else words
    for r in tail.groupBy(_tail_class(F.col("word")).alias("c")).agg(
            F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect():  # TAIL rows
        class_n[r["c"]], class_v[r["c"]] = r["n"], r["v"]
    net = LogBilinear()
    shared = spark.sparkContext.broadcast(top)
    tri = texts.mapInArrow(_count_trigrams(shared), "k int, n bigint").groupBy("k").agg(
        F.sum("n").alias("n")).orderBy("k").toArrow()  # at most CLASSES ** 3 rows
    if tri.num_rows:
        net.train(tri["k"].to_numpy().astype(np.int64), tri["n"].to_numpy().astype(float))
    return Model(counts, net, top, hot, size["n"] or 0, size["v"], class_n, class_v)


def _scorer(shared):
    def make():
        net, top, hot, base, within, known_end, base_end = shared.value
        table = net.log10_table()
        n_hot = len(hot)
        # index of a word: its place among the hot words, or n_hot + its class
        index = {w.encode(): k for k, w in enumerate(hot)}
        number = {w.encode(): k for k, w in enumerate(top)}
        classes = np.array([number.get(w, -1) for w in index] + list(range(CLASSES)), np.int64)
        for k, w in enumerate(hot):
            if classes[k] < 0:
                classes[k] = tail_class(w)
        base_of = np.concatenate([base, np.zeros(CLASSES)])
        within_of = np.concatenate([within, np.zeros(CLASSES)])

        class Index(dict):
            def __missing__(self, word):
                k = n_hot + tail_class(word.decode())
                if len(self) < n_hot + 300_000:
                    self[word] = k
                return k
        lookup = Index(index)

        def run(texts):
            rows = []
            for t in texts:
                words = tokens_of(t)
                at = np.fromiter(map(lookup.__getitem__, words), np.int64, len(words))
                c = np.concatenate([[END, END], classes[at], [END]])
                cls = float(table[c[:-2] * CLASSES + c[1:-1], c[2:]].sum())
                rare = Counter([words[k] for k in np.flatnonzero(at >= n_hot).tolist()])
                n_hot_words = len(words) - sum(rare.values())
                rows.append((len(words) + 1, n_hot_words + known_end, float(base_of[at].sum()) + base_end,
                             cls + float(within_of[at].sum()), [w.decode() for w in rare], list(rare.values())))
            cols = list(zip(*rows)) or [[]] * 6
            return [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64()),
                    pa.array(cols[3], pa.float64()), pa.array(cols[4], pa.list_(pa.string())),
                    pa.array(cols[5], pa.list_(pa.int64()))]
        return run
    return make


def score(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """n_tokens, n_known, train_tokens, base_score and score (log10) of every row, after the columns ``keep``."""
    spark = docs.sparkSession
    names = [w for w, _ in model.hot]
    n_of = np.array([c for _, c in model.hot], float)
    room = model.class_n + 0.5 * (model.class_v + 1)
    base = np.log10((n_of + 0.5) / (model.n + 0.5 * (model.v + 1))) if names else n_of
    within = np.array([0.0 if k < len(model.top) else np.log10((c + 0.5) / room[tail_class(w)])
                       for k, (w, c) in enumerate(model.hot)])
    ends = model.counts.filter(F.col("word") == "").select("n").first()
    end_n = ends["n"] if ends else 0
    shared = spark.sparkContext.broadcast((model.net, model.top, names, base, within, int(end_n > 0),
                                           model.base(end_n)))
    cols = [f"c_{i}" for i in range(len(keep))]
    src = docs.select(*[F.col(f"`{k}`").alias(c) for k, c in zip(keep, cols)],
                      F.col(text_col).cast("string").alias("__text"),
                      F.monotonically_increasing_id().alias("row"))  # stored below, so it stays what it is
    part = land(map_texts(src, "__text", [*cols, "row"],
                          "n_tokens bigint, known bigint, base double, model double, rare array<string>, "
                          "times array<bigint>", _scorer(shared)), "scores")
    rare = part.select("row", F.explode(F.arrays_zip("rare", "times")).alias("z")).select(
        "row", F.col("z.rare").alias("word"), F.col("z.times").alias("t"))
    log_room = F.create_map(*[x for k in range(TOP + 1, CLASSES) for x in (F.lit(k).cast("bigint"),
                                                                          F.lit(float(np.log10(room[k]))))])
    c = F.coalesce(F.col("n"), F.lit(0))
    own = F.log10(c + 0.5)
    sums = rare.join(model.counts, "word", "left").groupBy("row").agg(
        F.sum(F.when(c > 0, F.col("t")).otherwise(0)).alias("k"),
        F.sum(F.col("t") * (own - log10(model.n + 0.5 * (model.v + 1)))).alias("b"),
        F.sum(F.col("t") * (own - log_room[_tail_class(F.col("word"))])).alias("m"))
    zero = F.lit(0.0)
    return part.join(sums, "row", "left").select(
        *[F.col(c).alias(k) for k, c in zip(keep, cols)], "n_tokens",
        (F.col("known") + F.coalesce("k", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(model.n).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("b", zero)).alias("base_score"),
        (F.col("model") + F.coalesce("m", zero)).alias("score"))
