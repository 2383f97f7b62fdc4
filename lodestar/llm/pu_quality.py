"""Quality scores by positive-unlabelled learning (operator 11).

Trusted positives are the rows whose labels are all 1; every training row, whatever its
label, is unlabelled web text.  A small network is trained in numpy to minimise the
non-negative unbiased risk

    prior * R(positives as 1) + max(0, R(unlabelled as 0) - prior * R(positives as 0))

with the logistic loss; where the second part falls below zero its gradient is
followed backwards, which keeps it from fitting the positives among the unlabelled as
negatives.  The score is the network's probability of a 1.

The share of positives among the unlabelled is estimated from the two samples alone: a
network told to part positives from unlabelled is fitted on one half of them, and on the
other half the share of unlabelled rows above a cut, over that of positives, is least
where the rows above are nearly all positive.  The cut minimises an upper confidence
bound of that ratio; the halves change places and the mean of both counts.

A text is seen as a whole, by shares only, so that its length does not matter: square roots of
the shares of each ASCII byte and of others, of hashed byte trigrams, of words equal
to the word before, of repeated lines and of the commonest word, and logs of mean
word and line length.  Nothing but the text is an input.

Bounds: at most POSITIVES and UNLABELLED training rows, those with the smallest id hashes,
reach the driver, as vectors of some 1.6 kB; features and scores of the other rows stay in their tasks.

Defined cases: a null text is the empty one, which has a vector (of zeros) and a score like any
other; labels that are null or neither 0 nor 1, or contradict each other, make no
trusted positive; a null id has no label; repeated rows count each.  Without a
trusted positive nothing can be learned and all scores are 0.5.  Extra columns pass or are not read.
"""

from __future__ import annotations

from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import id_text, land, map_texts

POSITIVES, UNLABELLED = 3_000, 9_000
TRIGRAMS, OTHERS = 256, 5
#: Bytes whose trigrams are hashed at a time.
CHUNK = 1 << 20
SIZE = 128 + 1 + TRIGRAMS + OTHERS
HIDDEN, STEPS, BATCH, RATE, DECAY = 24, 700, 512, 0.004, 3e-3
#: Standardised features are cut here, so that no text lies farther out than the network has seen.
FARTHEST = 6.0
#: Failure probability and slack of the prior's confidence bound.
DELTA, SLACK = 0.1, 0.01


def features(text: str | None) -> np.ndarray:
    """The vector of a whole text."""
    out = np.zeros(SIZE, np.float32)
    raw = (text or "").encode()
    if not raw:
        return out
    b = np.frombuffer(raw, np.uint8)
    byte = np.bincount(b, minlength=256)
    out[:128], out[128] = byte[:128], byte[128:].sum()
    tri = np.zeros(TRIGRAMS, np.int64)
    for a in range(0, len(b) - 2, CHUNK):
        c = b[a:a + CHUNK + 2].astype(np.uint32)
        code = (c[:-2] << 16 | c[1:-1] << 8 | c[2:]) * np.uint32(0x9E3779B1)
        tri += np.bincount(code >> 24, minlength=TRIGRAMS)
    out[:129] = np.sqrt(out[:129] / len(b))
    out[129:129 + TRIGRAMS] = np.sqrt(tri / max(1, len(b) - 2))
    words = raw.split()
    if words:
        lines = [x for x in raw.split(b"\n") if x.strip()]
        n = len(words)
        out[-OTHERS:] = (np.sqrt(sum(map(eq, words, words[1:])) / n),
                         np.sqrt(1 - len(set(lines)) / len(lines)),
                         np.sqrt(max(Counter(words).values()) / n) if n > 20 else 0.0,
                         np.log(sum(map(len, words)) / n) / 4, np.log(n / len(lines) + 1) / 8)
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


class Net:
    """One hidden layer over standardised features."""

    def __init__(self, x: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.mean, self.std = x.mean(0), np.maximum(x.std(0), 0.01)
        self.p = {"w": rng.normal(0, 0.5 / np.sqrt(SIZE), (SIZE, HIDDEN)), "b": np.zeros(HIDDEN),
                  "u": rng.normal(0, 0.3, HIDDEN), "c": np.zeros(1)}
        self.prior = None

    def _scaled(self, x):
        return np.clip((x - self.mean) / self.std, -FARTHEST, FARTHEST)

    def scores(self, x: np.ndarray) -> np.ndarray:
        h = np.tanh(self._scaled(x) @ self.p["w"] + self.p["b"])
        return _sigmoid(h @ self.p["u"] + self.p["c"][0])

    def train(self, pos: np.ndarray, unl: np.ndarray, slope, seed: int = 13) -> "Net":
        """Adam; ``slope(zp, zu)`` gives the risk's derivative by the outputs of the two samples."""
        rng = np.random.default_rng(seed)
        pos, unl = self._scaled(pos), self._scaled(unl)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(a) for k, a in self.p.items()}
        for step in range(1, STEPS + 1):
            x = np.concatenate([pos[rng.integers(len(pos), size=BATCH)], unl[rng.integers(len(unl), size=BATCH)]])
            h = np.tanh(x @ self.p["w"] + self.p["b"])
            z = h @ self.p["u"] + self.p["c"][0]
            d = np.concatenate(slope(z[:BATCH], z[BATCH:]))
            back = d[:, None] * self.p["u"] * (1 - h * h)
            g = {"w": x.T @ back + DECAY * self.p["w"], "b": back.sum(0), "u": h.T @ d + DECAY * self.p["u"],
                 "c": np.array([d.sum()])}
            rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
            for k in self.p:
                m[k] += 0.1 * (g[k] - m[k])
                v[k] += 0.001 * (g[k] * g[k] - v[k])
                self.p[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
        return self


def _parting(zp, zu):
    """Plain logistic risk of positives against unlabelled rows, half each."""
    return 0.5 * (_sigmoid(zp) - 1) / len(zp), 0.5 * _sigmoid(zu) / len(zu)


def non_negative(prior: float):
    """The derivative of the non-negative unbiased risk."""
    def slope(zp, zu):
        as_zero = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        gp, gu = -prior * _sigmoid(zp) / len(zp), _sigmoid(zu) / len(zu)
        if as_zero < 0:
            return prior * (_sigmoid(zp) - 1) / len(zp), np.zeros_like(gu)
        return prior * (_sigmoid(zp) - 1) / len(zp) + gp, gu
    return slope


def estimate_prior(pos: np.ndarray, unl: np.ndarray) -> float:
    """The share of positives among the unlabelled."""
    found = []
    for k in (0, 1):
        net = Net(unl[k::2]).train(pos[k::2] if len(pos) > 1 else pos, unl[k::2], _parting, seed=17 + k)
        sp, su = np.sort(net.scores(pos[1 - k::2] if len(pos) > 1 else pos)), np.sort(net.scores(unl[1 - k::2]))
        if not len(su):
            continue
        above_p = 1 - np.searchsorted(sp, sp, "left") / len(sp)
        above_u = 1 - np.searchsorted(su, sp, "left") / len(su)
        doubt = sum(np.sqrt(np.log(4 / DELTA) / (2 * n)) for n in (len(sp), len(su)))
        best = int(np.argmin((above_u + (1 + SLACK) * doubt) / above_p))
        found.append(above_u[best] / above_p[best])
    return float(np.clip(np.mean(found), 0.02, 0.98)) if found else 0.5


def _first(ids: DataFrame, salt: str, most: int) -> int | None:
    """The hash up to which some ``most`` ids lie."""
    h = F.xxhash64(F.lit(salt), F.col("id"))
    return ids.select(h.alias("h")).orderBy("h").limit(most).agg(F.max("h")).first()[0]


def samples(docs: DataFrame, labels: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text",
            label_col: str = "quality", positives: int = POSITIVES, unlabelled: int = UNLABELLED
            ) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of the trusted positives and of the unlabelled rows among those for which ``training`` holds."""
    rows = docs.filter(training).select(F.col(f"`{id_col}`").alias("doc"), id_text(id_col).alias("id"),
                                        F.col(f"`{text_col}`").alias("text"))
    one = labels.filter(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("doc")).agg(
        F.min(label_col).alias("least"), F.max(label_col).alias("most"))
    trusted = one.filter((F.col("least") == 1) & (F.col("most") == 1) & F.col("doc").isNotNull()).select("doc")
    trusted = land(rows.select("doc", "id").join(trusted, "doc", "left_semi").distinct(), "trusted-ids")
    cuts = {"positive": _first(trusted, "positive", positives), "unlabelled": _first(rows, "unlabelled", unlabelled)}
    if None in cuts.values():
        return np.zeros((0, SIZE)), np.zeros((0, SIZE))
    order = {k: F.xxhash64(F.lit(k), F.col("id")) for k in cuts}
    chosen = F.broadcast(trusted.withColumn("h", order["positive"]).orderBy("h").limit(positives).select(
        "doc", F.lit(True).alias("positive")))
    marked = (rows.join(chosen, "doc", "left").withColumn("positive", F.coalesce("positive", F.lit(False)))
              .withColumn("unlabelled", order["unlabelled"] <= cuts["unlabelled"])
              .filter(F.col("positive") | F.col("unlabelled")))

    def make():
        return lambda texts: [pa.array([features(t).tobytes() for t in texts], pa.binary())]

    found = land(map_texts(marked, "text", ["id", "positive", "unlabelled"], "vector binary", make), "quality-vectors")
    out = []
    for k, most in (("positive", positives), ("unlabelled", unlabelled)):
        # equal ids share a hash: the limit keeps the bound whatever the ids are
        got = found.filter(k).select("vector", order[k].alias("h")).orderBy("h", "vector").limit(most).collect()
        out.append(np.frombuffer(b"".join(r["vector"] for r in got), np.float32).reshape(-1, SIZE).astype(float))
    return out[0], out[1]


def fit(docs: DataFrame, labels: DataFrame, training: Column, prior: float | None = None, **columns) -> Net | None:
    """A network trained on the two samples; None without a trusted positive.  A known prior need not be estimated."""
    pos, unl = samples(docs, labels, training, **columns)
    if not len(pos):
        return None
    net = Net(unl)
    net.prior = estimate_prior(pos, unl) if prior is None else prior
    return net.train(pos, unl, non_negative(net.prior))


def score(docs: DataFrame, net: Net | None, keep: list[str], text_col: str = "text", out: str = "score") -> DataFrame:
    """``keep`` columns and the score of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(net)  # some 80 kB

    def make():
        model = shared.value

        def run(texts):
            if model is None:
                return [pa.array([0.5] * len(texts), pa.float64())]
            x = np.stack([features(t) for t in texts])
            return [pa.array(model.scores(x).astype(float), pa.float64())]
        return run

    return map_texts(docs, text_col, keep, f"`{out}` double", make)
