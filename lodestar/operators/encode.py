"""Text encoders and plug-in tokenizers.

The offline default encoder gives every token a fixed vector of small integers drawn from
its md5 and pools a text's vector from its tokens' vectors in whole numbers, so the result is the
same on any partitioning.  It comes in two forms with equal results: ``hash_encode`` on a table, which adds up
the rows that share their keys, and ``DrawEncoder`` as a plug-in, which shuffles nothing.

Plug-ins are applied to Arrow batches, a fixed number of texts at a time.  A plug-in is given as a *factory* (a picklable zero-argument callable).  Each
Python worker builds it once and keeps it for every later batch, as a model
server would keep weights loaded.  Besides ``DrawEncoder`` two ship here:

* ``VocabTokenizer`` — the vocabulary tokenizer of ``operators.tokens`` as a
  plug-in (vocabulary landed as Parquet, its most frequent words read once per worker);
* ``HashingEncoder`` — a deterministic stand-in for a model: every token gets
  a fixed pseudo-random vector seeded by its hash, the hidden states of a
  text are its tokens' vectors, pooled by mean (mask up to the last EOS) or by
  the last EOS position, then L2-normalised.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf, pandas_udf
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, FloatType, LongType, StructField, StructType

from lodestar.functions.vectors import l2_normalize, truncate_dims
from lodestar.session import qualified, scratch_path, ship_package
from lodestar.operators.tokens import SPECIAL_PATTERN, spaced_words

_SPECIAL = re.compile(SPECIAL_PATTERN)
#: Texts that the default encoder sees at a time.
TEXTS = 64
#: Plug-in objects that a Python worker keeps.
MAX_PLUGINS = 8
_CACHE: dict = {}

# Prompt markers (as in functions.text).
_MARK = {"query": "<unused0>", "document": "<unused1>"}


def _cached(factory):
    """The object that ``factory`` makes, once per worker.

    The key is the pickled factory, not its repr: that of a closure is an address, which Python uses again.
    """
    key = hashlib.sha256(cloudpickle.dumps(factory)).digest()
    if key not in _CACHE:
        while len(_CACHE) >= MAX_PLUGINS:
            _CACHE.pop(next(iter(_CACHE)))
        _CACHE[key] = factory()
    return _CACHE[key]


def _words(text: str) -> list[str]:
    return _SPECIAL.sub(r" \1 ", text).split()


#: Most frequent words (lowest ids) that a vocabulary tokenizer holds; the ids of others come with their texts.
HOT_IDS = 1 << 16


class VocabTokenizer:
    def __init__(self, mapping: dict, unk: int = 3, bos: int = 2):
        self.mapping, self.unk, self.bos = mapping, unk, bos

    @classmethod
    def load(cls, path: str):
        """The words of the landed vocabulary with ids below HOT_IDS."""
        import pyarrow.parquet as pq
        from pyarrow import fs as pafs

        uri = re.sub("^file:/+", "file:///", path) if ":/" in path else "file://" + path
        filesystem, root = pafs.FileSystem.from_uri(uri)
        t = pq.read_table(root, filesystem=filesystem, columns=["token", "id"], filters=[("id", "<", HOT_IDS)])
        return cls(dict(zip(t.column("token").to_pylist(), t.column("id").to_pylist())))

    @staticmethod
    def factory(path: str):
        """``path`` is resolved on the driver, by the session's default filesystem."""
        from pyspark.sql import SparkSession

        return functools.partial(VocabTokenizer.load, qualified(SparkSession.getActiveSession(), path))

    def encode(self, text: str, rare: dict | None = None) -> list[int]:
        m, r = self.mapping, rare or {}
        return [self.bos] + [m[w] if w in m else r.get(w, self.unk) for w in _words(text)]


def tokenize_udf(factory):
    """pandas UDF (text, words, ids) -> array<int> with the tokenizer built by ``factory``; ``words`` and ``ids``
    are those of the text that the tokenizer does not hold (``with_rare_words``)."""
    from pyspark.sql import SparkSession

    active = SparkSession.getActiveSession()
    if active is not None:
        ship_package(active)
    @pandas_udf("array<int>")
    def tok(it: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        t = _cached(factory)
        for texts, words, ids in it:
            yield pd.Series([None if x is None else t.encode(x, None if w is None else dict(zip(w, i)))
                             for x, w, i in zip(texts, words, ids)], dtype=object)
    return tok


def with_rare_words(df: DataFrame, text: str, vocab: DataFrame, words: str = "rare_words", ids: str = "rare_ids") -> DataFrame:
    """Adds the words of each text that ``vocab`` (token, id) has with ids of HOT_IDS and more, and their ids.

    A worker so holds a bounded part of the vocabulary, and no frequent word is shuffled.  Rows
    are landed under a number of their own: they may be equal.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "texts")
    df.withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.schema(StructType([*df.schema.fields, StructField("_row", LongType())])).parquet(path)
    used = rows.select("_row", F.explode(F.array_distinct(spaced_words(text))).alias("token"))
    used = used.join(F.broadcast(vocab.filter(F.col("id") < HOT_IDS).select("token")), "token", "left_anti")
    found = used.join(vocab.filter(F.col("id") >= HOT_IDS).select("token", "id"), "token").groupBy("_row").agg(
        F.collect_list(F.struct("token", "id")).alias("_found"))
    return rows.join(found, "_row", "left").select(
        *[F.col(c) for c in df.columns], F.col("_found.token").alias(words), F.col("_found.id").alias(ids))


class HashingEncoder:
    """Token vector = row ``xxhash64(token) mod 2^bits`` of a fixed seeded
    Gaussian table (the same table on every worker)."""

    def __init__(self, dim: int = 64, seed: int = 0, bits: int = 16):
        self.dim, self.seed = dim, seed
        self.table = np.random.default_rng(seed).standard_normal((1 << bits, dim))
        self.mask = (1 << bits) - 1

    @staticmethod
    def factory(dim: int = 64, seed: int = 0):
        return functools.partial(HashingEncoder, dim, seed)

    def tokens(self, text: str, role: str | None, max_length: int | None) -> list[str]:
        """The framed words; a limit cuts words but keeps the closing ``<eos>``."""
        mark = _MARK.get(role or "")
        toks = ["<bos>"] + _words(f"{mark}{text}<eos>" if mark else f"{text}<eos>")
        if max_length is not None and len(toks) > max_length:
            toks = toks[:max_length - 1] + ["<eos>"]
        return toks

    def encode(self, texts, roles, pooling: str = "mean", max_length: int | None = None, normalize: bool = True):
        """Vectors of a batch of texts (None for a null text): one table lookup for all tokens."""
        import xxhash

        toks = [None if t is None else self.tokens(t, r, max_length) for t, r in zip(texts, roles)]
        size = np.array([len(t or ()) for t in toks], np.int64)
        ids = np.fromiter((xxhash.xxh64_intdigest(w) & self.mask for t in toks if t for w in t), np.int64, size.sum())
        full = np.flatnonzero(size)
        ends = np.cumsum(size[full])
        if not len(full):
            return [None] * len(toks)
        if pooling == "mean":  # every token up to the last <eos>, which closes the text
            v = np.add.reduceat(self.table[ids], ends - size[full], axis=0) / size[full][:, None]
        else:
            v = self.table[ids[ends - 1]]
        if normalize:
            v = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
        out: list = [None] * len(toks)
        for k, x in zip(full.tolist(), v.astype(np.float32)):
            out[k] = x
        return out


#: Dimensions of the default encoder: one 16-bit draw each, eight to an md5.
HASH_DIMS = 64


#: Tokens whose vectors are gathered at once (8 MB at 64 dimensions).
DRAW_BLOCK = 1 << 14


class _Rows(dict):
    """token -> row of its draws; a token not yet there gets the next row, and its draws join ``new``."""

    def __init__(self, dim: int, seed: int):
        self.new: list = []
        self.prefixes = [f"{seed}|vector{b}|".encode() for b in range(-(-dim // 8))]

    def __missing__(self, token):
        raw = token.encode()
        self.new.append(b"".join([hashlib.md5(p + raw).digest() for p in self.prefixes]))
        row = self[token] = len(self)
        return row


class DrawEncoder:
    """The default encoder as a model object: framing, draws and pooling as in ``hash_encode``.

    Draws of tokens are kept, up to ``keep`` of them (some 35 MB at 64 dimensions).
    """

    def __init__(self, dim: int = HASH_DIMS, seed: int = 0, keep: int = 1 << 17):
        self.dim, self.seed, self.keep = dim, seed, max(keep, DRAW_BLOCK)
        self.rows, self.table = _Rows(dim, seed), np.zeros((0, dim), np.int16)

    @staticmethod
    def factory(dim: int = HASH_DIMS, seed: int = 0):
        return functools.partial(DrawEncoder, dim, seed)

    def draws(self, tokens: list[str]) -> np.ndarray:
        """Vectors of at most DRAW_BLOCK tokens."""
        if len(self.rows) + len(tokens) > self.keep:
            self.rows = _Rows(self.dim, self.seed)
        at = np.fromiter(map(self.rows.__getitem__, tokens), np.int64, len(tokens))
        if self.rows.new:
            n, had = len(self.rows), len(self.rows) - len(self.rows.new)
            if n > len(self.table):
                room = np.zeros((min(self.keep, max(2 * n, 1024)), self.dim), np.int16)
                room[:had] = self.table[:had]
                self.table = room
            raw = np.frombuffer(b"".join(self.rows.new), ">u2").reshape(n - had, -1)[:, :self.dim]
            self.table[had:n] = raw.astype(np.int32) - 32768
            self.rows.new = []
        return self.table[at].astype(np.float64)

    def sums(self, texts, roles, pooling: str = "mean", max_length: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Weighted sums of the tokens' draws, a row per text, and the texts' numbers of tokens.

        They are whole numbers far below 2**53: exact in any order.
        """
        out, size = np.zeros((len(texts), self.dim)), np.zeros(len(texts), np.int64)
        held, ends, of = [], [], []  # tokens of a block, where each text's part ends, and its (text, first position)

        def flush():
            if held:
                v, a = self.draws(held), 0
                for b, (k, first) in zip(ends, of):
                    w = np.ones(b - a) if pooling == "mean" else 1.0 + np.arange(first, first + b - a) % 7
                    out[k] += w @ v[a:b]
                    a = b
                for x in (held, ends, of):
                    x.clear()
        for k, (text, role) in enumerate(zip(texts, roles)):
            mark = _MARK.get(role or "")
            toks = ["<bos>", *([mark] if mark else []), *text.split()]
            if max_length is not None:
                toks = toks[:max_length - 1]
            toks.append("<eos>")
            size[k] = len(toks)
            for a in range(0, len(toks), DRAW_BLOCK):
                part = toks[a:a + DRAW_BLOCK]
                if len(held) + len(part) > DRAW_BLOCK:
                    flush()
                held += part
                ends.append(len(held))
                of.append((k, a))
        flush()
        return out, size

    def encode(self, texts, roles, pooling: str = "mean", max_length: int | None = None, normalize: bool = True):
        """One vector per text."""
        v, size = self.sums(texts, roles, pooling, max_length)
        if normalize:
            n = np.sqrt((v * v).sum(1, keepdims=True))
            return v / np.where(n > 0, n, 1.0)
        return v / (size[:, None] * 32768.0 if pooling == "mean" else 32768.0)


def hash_encode(df: DataFrame, keys, text: str, role, pooling: str = "mean", max_length: int | None = None,
                normalize: bool = True, dims: int = HASH_DIMS, seed: int = 0, out: str = "embedding") -> DataFrame:
    """(keys, ``out`` array<double>, ``reason``): the default encoder on a table of texts.

    A text is framed as ``<bos>``, the role's mark, its words, ``<eos>``.  Mean pooling
    averages the vectors of all tokens; EOS pooling takes the running state at the
    ``<eos>``, the sum of all vectors so far, token i counting 1 + i mod 7 times.  No length limit by
    default; with ``max_length`` words are cut and ``<eos>`` stays the last token.

    Tasks sum the tokens of their texts in whole numbers, and only a row of sums per text is shuffled, by
    ``keys``: the sums of rows that share them are added up.  A null text has a null vector and the reason
    ``null_text``; every other text has a vector and a null reason.
    """
    if pooling not in ("mean", "eos"):
        raise ValueError(f"Invalid pooling method: {pooling}")
    ship_package(df.sparkSession)
    keys = [keys] if isinstance(keys, str) else list(keys)
    role_c: Column = F.col(role) if isinstance(role, str) else role
    texts = df.select(*keys, F.col(text).isNull().alias("_null"), F.coalesce(F.col(text), F.lit("")).alias("_text"),
                      role_c.cast("string").alias("_role"))
    schema = StructType([texts.schema[k] for k in [*keys, "_null"]] + [StructField("_c", LongType())]
                        + [StructField(f"_w{i}", LongType()) for i in range(dims)])
    words = texts.mapInArrow(_text_sums(DrawEncoder.factory(dims, seed), pooling, max_length, to_arrow_schema(schema)), schema)
    sums = words.groupBy(*keys, "_null").agg(F.sum("_c").alias("_n"), *[F.sum(f"_w{i}").alias(f"_s{i}") for i in range(dims)])
    vec = F.array(*[F.col(f"_s{i}").cast("double") for i in range(dims)])
    if normalize:
        div = F.sqrt(F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x * x))
    else:
        div = F.col("_n") * 32768.0 if pooling == "mean" else F.lit(32768.0)
    # the divisor is made once per row and handed to the lambda element by element
    values = F.zip_with(vec, F.array_repeat(div, dims), lambda x, n: F.when(n > 0, x / n).otherwise(F.lit(0.0)))
    return sums.select(*keys, F.when(~F.col("_null"), values).alias(out),
                       F.when(F.col("_null"), F.lit("null_text")).alias("reason"))


def _text_sums(factory, pooling, max_length, arrow):
    def run(batches):
        e = _cached(factory)
        for batch in batches:
            for a in range(0, batch.num_rows, TEXTS):
                part = batch.slice(a, TEXTS)
                v, n = e.sums(part.column("_text").to_pylist(), part.column("_role").to_pylist(), pooling, max_length)
                kept = [part.column(i) for i in range(part.num_columns - 2)]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(n), *map(pa.array, v.T.astype(np.int64))], schema=arrow)
    return run


def encode_texts(df: DataFrame, text: str, role, encoder_factory, pooling: str = "mean",
                 max_length: int | None = None, normalize: bool = True, batch_size: int = 64, out: str = "embedding",
                 element: str = "float") -> DataFrame:
    """Add ``out`` = vectors of ``text`` (role: column or literal) from a plug-in encoder, which sees
    ``batch_size`` texts at a time.  Only a null text has a null vector."""
    if pooling not in ("mean", "eos"):
        raise ValueError(f"Invalid pooling method: {pooling}")
    ship_package(df.sparkSession)
    role_c: Column = F.col(role) if isinstance(role, str) else role

    kind = pa.float64() if element == "double" else pa.float32()

    @arrow_udf(ArrayType(DoubleType() if element == "double" else FloatType()))
    def enc(it: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        e = _cached(encoder_factory)
        for texts, roles in it:
            out = [pa.array([], pa.list_(kind))]
            for a in range(0, len(texts), batch_size):  # a batch's strings and vectors go before the next one's are made
                v = np.stack(e.encode(texts.slice(a, batch_size).to_pylist(), roles.slice(a, batch_size).to_pylist(),
                                      pooling, max_length, normalize))
                ends = np.arange(len(v) + 1, dtype=np.int32) * v.shape[1]
                out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(v.ravel(), kind)))
            yield pa.concat_arrays(out)

    vec = enc(F.coalesce(F.col(text), F.lit("")), F.coalesce(role_c, F.lit("")))
    return df.withColumn(out, F.when(F.col(text).isNotNull(), vec))


def attach_embeddings(df: DataFrame, text: str, encoder_factory, dims: int, role="role",
                      pooling: str = "mean", batch_size: int = 64, out: str = "embedding",
                      element: str = "float") -> DataFrame:
    """Teacher vectors for samples: encode, keep the first ``dims`` dimensions, re-normalise."""
    t = encode_texts(df, text, role, encoder_factory, pooling=pooling, normalize=False, batch_size=batch_size,
                     out="_full", element=element)
    return t.withColumn(out, l2_normalize(truncate_dims("_full", dims)).cast(f"array<{element}>")).drop("_full")
