"""Language identification by a byte convolutional network (operator 3).

A text is cut into windows of ``WINDOW`` bytes, all of them, the last one padded.
The network embeds bytes, applies filters of several widths, takes each
filter's maximum over the window and puts a softmax on top.  A text's
probabilities are those of its windows, weighted by their bytes.

Training is numpy on the driver over a bounded sample: of each language the
``rows_per_lang`` training rows with the smallest id hash (``max_rows`` in all), and of
each row ``windows_per_row`` windows spread evenly over the text.  The hash
cut-offs come from ids alone, so texts are read only for the sample.  Prediction covers all
rows and whole texts, and sees nothing but the text.

A null text or one without a letter is ``und`` with score 0, and so is every text
if there is no labelled row.  Equal probabilities go to the first language in
sorted order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import map_texts

WINDOW = 256
EMBED, WIDTHS, FILTERS = 8, (2, 3, 4), 16
ROWS_PER_LANG, MAX_ROWS, WINDOWS_PER_ROW = 400, 20_000, 4
STEPS, BATCH, RATE = 240, 96, 0.01
UNKNOWN = "und"
_letter = regex.compile(r"\p{L}")


class Net:
    """Byte CNN; all widths share one matrix product, narrow filters being padded with zeros."""

    def __init__(self, langs: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.langs, w, n = langs, max(WIDTHS), len(WIDTHS) * FILTERS
        self.p = {"emb": rng.normal(0, 0.5, (256, EMBED)), "conv": rng.normal(0, 0.3, (w * EMBED, n)),
                  "bias": np.zeros(n), "out": rng.normal(0, 0.1, (n, len(langs))), "off": np.zeros(len(langs))}
        self.mask = np.concatenate([np.repeat((np.arange(w) < k), EMBED)[:, None].repeat(FILTERS, 1)
                                    for k in WIDTHS], 1)
        self.p["emb"][0] = 0  # padding
        self.p["conv"] *= self.mask
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _patches(self, x: np.ndarray) -> np.ndarray:
        """(windows, positions, width * EMBED) byte embeddings."""
        w = max(WIDTHS)
        e = self.p["emb"][np.pad(x, ((0, 0), (0, w - 1)))]
        n = x.shape[1]
        return np.concatenate([e[:, k:k + n] for k in range(w)], 2)

    def _pool(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        patches = self._patches(x)
        conv = (patches.reshape(-1, patches.shape[2]) @ self.p["conv"]).reshape(*patches.shape[:2], -1)
        return patches, conv

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Softmax of each window, in batches that fit the cache."""
        out = np.empty((len(x), len(self.langs)), np.float32)
        for a in range(0, len(x), 64):
            top = np.maximum(self._pool(x[a:a + 64])[1].max(1) + self.p["bias"], 0)
            z = top @ self.p["out"] + self.p["off"]
            z = np.exp(z - z.max(1, keepdims=True))
            out[a:a + 64] = z / z.sum(1, keepdims=True)
        return out

    def train(self, x: np.ndarray, y: np.ndarray, seed: int = 11) -> None:
        """Adam on cross entropy; the gradient of a maximum goes to its position only."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(a) for k, a in self.p.items()}
        per = [np.flatnonzero(y == c) for c in range(len(self.langs))]
        for step in range(1, STEPS + 1):
            lang = rng.integers(0, len(per), BATCH)  # languages in equal shares
            at = np.array([per[c][rng.integers(len(per[c]))] for c in lang])
            xb, yb = x[at], y[at]
            patches, conv = self._pool(xb)
            where = conv.argmax(1)
            raw = np.take_along_axis(conv, where[:, None], 1)[:, 0] + self.p["bias"]
            top = np.maximum(raw, 0)
            z = top @ self.p["out"] + self.p["off"]
            z = np.exp(z - z.max(1, keepdims=True))
            z /= z.sum(1, keepdims=True)
            z[np.arange(BATCH), yb] -= 1
            z /= BATCH
            g = {"out": top.T @ z, "off": z.sum(0)}
            d = (z @ self.p["out"].T) * (raw > 0)
            best = np.take_along_axis(patches, where[:, :, None], 1)  # (window, filter, width * EMBED)
            g["conv"] = np.einsum("bfk,bf->kf", best, d) * self.mask
            g["bias"] = d.sum(0)
            back = (d[:, :, None] * self.p["conv"].T[None]).reshape(BATCH, d.shape[1], -1, EMBED)
            pos = where[:, :, None] + np.arange(back.shape[2])
            ids = np.take_along_axis(np.pad(xb, ((0, 0), (0, back.shape[2] - 1))), pos.reshape(BATCH, -1), 1)
            g["emb"] = np.zeros_like(self.p["emb"])
            np.add.at(g["emb"], ids.ravel(), back.reshape(-1, EMBED))
            g["emb"][0] = 0
            for k in self.p:
                m[k] += 0.1 * (g[k] - m[k])
                v[k] += 0.001 * (g[k] * g[k] - v[k])
                self.p[k] -= (RATE * (m[k] / (1 - 0.9 ** step))
                              / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-7)).astype(np.float32)

    def predict(self, texts: list) -> tuple[list[str], list[float]]:
        if not self.langs:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        raw = [t.encode() if t and _letter.search(t) else b"" for t in texts]
        n = np.array([-(-len(b) // WINDOW) for b in raw], np.int64)
        buf = np.frombuffer(b"".join(b.ljust(k * WINDOW, b"\0") for b, k in zip(raw, n.tolist())), np.uint8)
        p = self.probabilities(buf.reshape(-1, WINDOW))
        ends = np.cumsum(n)
        owner = np.repeat(np.arange(len(raw)), n)
        size = np.array(list(map(len, raw)), np.int64)
        weight = np.minimum(WINDOW, size[owner] - WINDOW * (np.arange(len(owner)) - (ends - n)[owner]))
        total = np.zeros((len(raw), len(self.langs)))
        np.add.at(total, owner, p * weight[:, None])
        total /= np.maximum(size, 1)[:, None]
        best = total.argmax(1)
        return ([self.langs[b] if s else UNKNOWN for b, s in zip(best, size.tolist())],
                np.minimum(total.max(1), 1.0).tolist())


def training_windows(docs: DataFrame, labelled: Column, id_col: str = "doc_id", text_col: str = "text",
                     lang_col: str = "lang", rows_per_lang: int = ROWS_PER_LANG, max_rows: int = MAX_ROWS) -> list:
    """Rows (lang, windows) of the sample."""
    h = F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    rows = docs.select(F.col(lang_col).alias("lang"), h.alias("h"), F.col(text_col).alias("text"),
                       labelled.alias("ok")).filter(F.col("ok") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    ranked = rows.select("lang", "h").withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
    first = ranked.filter(F.col("r") <= rows_per_lang).orderBy("r", "lang").limit(max_rows)
    cuts = {r["lang"]: r["h"] for r in first.groupBy("lang").agg(F.max("h").alias("h")).collect()}
    if not cuts:
        return []
    keep = F.lit(False)
    for lang, cut in sorted(cuts.items()):
        keep = keep | ((F.col("lang") == lang) & (F.col("h") <= cut))
    last = F.greatest(F.char_length("text") - WINDOW, F.lit(0))
    cut = F.array(*[F.substr(F.col("text"), F.floor(last * k / max(1, WINDOWS_PER_ROW - 1)).cast("int") + 1,
                             F.lit(WINDOW)) for k in range(WINDOWS_PER_ROW)])
    # equal ids share a hash: the limit keeps the bound whatever the ids are
    return rows.filter(keep).select("lang", "h", cut.alias("windows")).orderBy("h", "lang", "windows").limit(
        max_rows).collect()


def fit(docs: DataFrame, labelled: Column, **columns) -> Net:
    """A network trained on the sample of the rows for which ``labelled`` holds."""
    sample = training_windows(docs, labelled, **columns)
    pairs = [(w.encode()[:WINDOW].ljust(WINDOW, b"\0"), r["lang"]) for r in sample for w in r["windows"]
             if _letter.search(w)]
    langs = sorted({lang for _, lang in pairs})
    net = Net(langs)
    if len(langs):
        x = np.frombuffer(b"".join(w for w, _ in pairs), np.uint8).reshape(-1, WINDOW)
        number = {lang: k for k, lang in enumerate(langs)}
        net.train(x, np.array([number[lang] for _, lang in pairs]))
    return net


def predict(docs: DataFrame, net: Net, text_col: str = "text", keep: list[str] | None = None,
            lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """Add the predicted language and its probability to every row."""
    shared = docs.sparkSession.sparkContext.broadcast(net)  # some 10 kB

    def make():
        model = shared.value

        def run(texts):
            lang, score = model.predict(texts)
            return [pa.array(lang, pa.string()), pa.array(score, pa.float64())]
        return run

    return map_texts(docs, text_col, docs.columns if keep is None else keep,
                     f"`{lang_out}` string, `{score_out}` double", make)
