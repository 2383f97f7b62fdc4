"""Byte-level BPE with word ends, merged through a segment tree (operator 8).

A word starts as one symbol per byte (the last one in its word-end form).  The
leaves of a segment tree hold ``rank * width + position`` of each adjacent pair
that can merge; the root is then the leftmost pair of the lowest rank.  A merge
changes up to three leaves, each a walk to the root, until the root holds none.

Words of up to ``WIDE`` symbols are merged side by side: one numpy step does one
merge of every word of a batch.  Longer words use the same tree word by word
(n log n).  Normalisation and the cut into words follow the tokenizer's file;
its own added tokens are cut out of the raw text first, as the library does.

``encode`` gives the ids, ``decode`` the text of ids (tokens joined by spaces where
the file has no decoder).  Null texts are empty texts: no ids, empty text.
"""

from __future__ import annotations

import json
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import map_texts
from lodestar.llm.wordcache import WordCache

#: Longest word, in symbols, that is merged in lockstep, and words per lockstep batch.
WIDE, LOCKSTEP = 64, 8192
NONE = np.int32(np.iinfo(np.int32).max)

# Fixed value: what the library's \s matches; str.split() also cuts at 1C-1F.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_white_run = regex.compile(f"[{WHITE}]+")
_odd_white = regex.compile("[\\x1c-\\x1f]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Rule: printable Latin-1 stands for itself; the others, in order, are 256, 257, ...
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    keep = set(own)
    return [chr(b) if b in keep else chr(next(rest)) for b in range(256)]


class Tree:
    """Segment tree over one word's pair keys; ``root()`` is the least key."""

    def __init__(self, leaves: list[int], none: int):
        w = 1
        while w < max(1, len(leaves)):
            w *= 2
        t = [none] * w + leaves + [none] * (w - len(leaves))
        for j in range(w - 1, 0, -1):
            t[j] = min(t[2 * j], t[2 * j + 1])
        self.width, self.t = w, t

    def root(self) -> int:
        return self.t[1]

    def put(self, i: int, key: int) -> None:
        t, j = self.t, self.width + i
        t[j] = key
        j //= 2
        while j:
            a, b = t[2 * j], t[2 * j + 1]
            t[j] = a if a < b else b
            j //= 2


class Bpe:
    """A tokenizer file's BPE model."""

    def __init__(self, raw: bytes):
        from tokenizers import Tokenizer

        spec = json.loads(raw)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix"):
            raise ValueError("a BPE model without dropout and subword prefix is needed")
        self.lib = Tokenizer.from_str(raw.decode())
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        signs = byte_symbols()
        self.inner = np.array([vocab[s] for s in signs], np.int32)
        self.last = np.array([vocab[s + suffix] for s in signs], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.n_ids = max(vocab.values()) + 1
        key = np.array([vocab[a] * self.n_ids + vocab[b] for a, b in pairs], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        order = np.argsort(key, kind="stable")
        self.key, self.rank_of_key = key[order], order.astype(np.int32)
        self.rank = dict(zip(key[::-1].tolist(), range(len(key) - 1, -1, -1)))
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")"
                                 ) if self.added else None
        self.tokens = [""] * (max([self.n_ids - 1, *self.added.values()]) + 1)
        for t, i in chain(vocab.items(), self.added.items()):
            self.tokens[i] = t
        self.joiner = " " if spec.get("decoder") is None else None
        self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.words = WordCache(self._merge_words)
        self.chunks = WordCache(self._encode_chunks, 120_000)

    # -- merges -----------------------------------------------------------------------------
    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of the pairs (a, b); NONE where they do not merge or a symbol is missing."""
        k = a.astype(np.int64) * self.n_ids + b
        at = np.searchsorted(self.key, k)
        at[at == len(self.key)] = 0
        return np.where((self.key[at] == k) & (a >= 0) & (b >= 0), self.rank_of_key[at], NONE)

    def _lockstep(self, words: list[bytes], width: int) -> list[bytes]:
        """Merge words of 2 to ``width`` symbols, one merge of each word per step."""
        n, w = len(words), width
        lens = np.fromiter(map(len, words), np.int64, n)
        sym = np.full((n, w + 1), -1, np.int32)
        flat = np.frombuffer(b"".join(words), np.uint8)
        row = np.repeat(np.arange(n), lens)
        col = np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)
        sym[row, col] = self.inner[flat]
        ends = np.cumsum(lens) - 1
        sym[np.arange(n), lens - 1] = self.last[flat[ends]]
        # right[i]: position of the symbol after i; w where there is none.  left likewise, -1.
        right = np.tile(np.arange(1, w + 2, dtype=np.int32), (n, 1))
        right[np.arange(n), lens - 1] = w
        left = np.tile(np.arange(-1, w, dtype=np.int32), (n, 1))
        tree = np.full((n, 2 * w), NONE, np.int32)
        ranks = self._ranks(sym[:, :w], sym[:, 1:])
        tree[:, w:] = np.where(ranks != NONE, ranks * w + np.arange(w, dtype=np.int32), NONE)
        for j in range(w - 1, 0, -1):
            np.minimum(tree[:, 2 * j], tree[:, 2 * j + 1], out=tree[:, j])

        def put(rows, pos, keys):
            j = pos + w
            tree[rows, j] = keys
            j = j >> 1
            while j[0]:
                tree[rows, j] = np.minimum(tree[rows, 2 * j], tree[rows, 2 * j + 1])
                j = j >> 1

        rows = np.flatnonzero(tree[:, 1] != NONE)
        while len(rows):
            root = tree[rows, 1]
            pos, new = root % w, self.merged[root // w]
            gone = right[rows, pos]
            after = right[rows, gone]
            sym[rows, pos], sym[rows, gone] = new, -1
            right[rows, pos], left[rows, after] = after, pos
            put(rows, gone, NONE)
            r = self._ranks(new, sym[rows, after])
            put(rows, pos, np.where(r != NONE, r * w + pos, NONE))
            prev = left[rows, pos]
            k = np.flatnonzero(prev >= 0)
            if len(k):
                rk, pk = rows[k], prev[k]
                r = self._ranks(sym[rk, pk], new[k])
                put(rk, pk, np.where(r != NONE, r * w + pk, NONE))
            rows = rows[tree[rows, 1] != NONE]
        alive = sym[:, :w] >= 0
        ids = sym[:, :w][alive].astype("<u4").tobytes()
        at = [0, *(4 * np.cumsum(alive.sum(1))).tolist()]
        return [ids[a:b] for a, b in zip(at, at[1:])]

    def _one(self, word: bytes) -> bytes:
        """Merge one word of any length through its own tree."""
        sym = self.inner[np.frombuffer(word, np.uint8)].tolist()
        sym[-1] = int(self.last[word[-1]])
        n, rank, none = len(sym), self.rank, 1 << 62
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))

        def key(i, j):
            r = rank.get(sym[i] * self.n_ids + sym[j])
            return none if r is None else r * n + i

        tree = Tree([key(i, i + 1) for i in range(n - 1)] + [none], none)
        while (root := tree.root()) != none:
            r, i = divmod(root, n)
            gone = right[i]
            after = right[gone]
            sym[i], sym[gone], right[i] = int(self.merged[r]), -1, after
            tree.put(gone, none)
            if after < n:
                left[after] = i
                tree.put(i, key(i, after))
            else:
                tree.put(i, none)
            if left[i] >= 0:
                tree.put(left[i], key(left[i], i))
        return np.array([s for s in sym if s >= 0], "<u4").tobytes()

    def _merge_words(self, words: list[str]) -> list[bytes]:
        raw = [w.encode() for w in words]
        out: list = [None] * len(raw)
        classes: dict[int, list[int]] = {}
        for k, b in enumerate(raw):
            n = len(b)
            if n == 1:
                out[k] = self.last[b[0]].astype("<u4").tobytes()
            elif n > WIDE:
                out[k] = self._one(b)
            else:
                classes.setdefault(1 << (n - 1).bit_length(), []).append(k)
        for width, ks in classes.items():
            for a in range(0, len(ks), LOCKSTEP):
                part = ks[a:a + LOCKSTEP]
                for k, ids in zip(part, self._lockstep([raw[k] for k in part], width)):
                    out[k] = ids
        return out

    # -- texts ------------------------------------------------------------------------------
    def _words_of(self, chunk: str) -> list[str]:
        """The words of a piece of text without white space and added tokens."""
        if chunk.isascii():
            return self.split.findall(chunk.lower())
        norm = self.lib.normalizer.normalize_str(chunk)
        if max(norm) < "ɐ":
            return self.split.findall(norm)
        # other scripts: the library's own cut, in case its Unicode tables are of another version
        signs = {s: b for b, s in enumerate(byte_symbols())}
        return [bytes(signs[c] for c in w).decode() for w, _ in self.lib.pre_tokenizer.pre_tokenize_str(norm)]

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        cut = [[(self.added.get(p), self._words_of(p) if p and p not in self.added else ()) for p in
                (self.cut.split(c) if self.cut and "<" in c else (c,))] for c in chunks]
        known = self.words.table(ws for parts in cut for _, ws in parts)
        return [b"".join(np.uint32(a).tobytes() if a is not None else b"".join(known[w] for w in ws)
                         for a, ws in parts) for parts in cut]

    def chunks_of(self, text: str) -> list[str]:
        if _odd_white.search(text):
            return [c for c in _white_run.split(text) if c]
        return text.split()

    def encode(self, texts: list) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut = [self.chunks_of(t) if t else [] for t in texts]
        get = self.chunks.table(cut).__getitem__
        return [b"".join(map(get, c)) for c in cut]

    def decode(self, packed: list) -> list[str]:
        """Texts of packed ids; null is the empty text.  Ids beyond the vocabulary raise IndexError."""
        if self.joiner is None:
            return [self.lib.decode(np.frombuffer(p or b"", "<u4").tolist(), skip_special_tokens=False)
                    for p in packed]
        get = self.tokens.__getitem__
        return [self.joiner.join(map(get, np.frombuffer(p or b"", "<u4").tolist())) for p in packed]


@lru_cache(maxsize=2)
def load(raw: bytes) -> Bpe:
    return Bpe(raw)


def _file(path: str) -> bytes:
    with open(path, "rb") as f:  # the tokenizer's file lies with the driver, a few MB
        return f.read()


def encode(docs: DataFrame, tokenizer_path: str, text_col: str = "text", out: str = "ids",
           keep: list[str] | None = None) -> DataFrame:
    """Add ``out``: the ids of the text, packed as little-endian unsigned 32-bit integers."""
    raw = docs.sparkSession.sparkContext.broadcast(_file(tokenizer_path))

    def make():
        bpe = load(raw.value)
        return lambda texts: [pa.array(bpe.encode(texts), pa.binary())]

    return map_texts(docs, text_col, docs.columns if keep is None else keep, f"`{out}` binary", make)


def decode(docs: DataFrame, tokenizer_path: str, ids_col: str = "ids", out: str = "decoded",
           keep: list[str] | None = None) -> DataFrame:
    """Add ``out``: the text of packed ids."""
    raw = docs.sparkSession.sparkContext.broadcast(_file(tokenizer_path))

    def make():
        bpe = load(raw.value)
        return lambda packed: [pa.array(bpe.decode(packed), pa.string())]

    return map_texts(docs, ids_col, docs.columns if keep is None else keep, f"`{out}` string", make)


def round_trip(docs: DataFrame, tokenizer_path: str, text_col: str = "text", ids_out: str = "ids",
               out: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """``encode`` and ``decode`` in one pass: the ids of each text, and the text that those ids give."""
    raw = docs.sparkSession.sparkContext.broadcast(_file(tokenizer_path))

    def make():
        bpe = load(raw.value)

        def run(texts):
            ids = bpe.encode(texts)
            return [pa.array(ids, pa.binary()), pa.array(bpe.decode(ids), pa.string())]
        return run

    return map_texts(docs, text_col, docs.columns if keep is None else keep,
                     f"`{ids_out}` binary, `{out}` string", make)


def n_ids(packed: Column) -> Column:
    return (F.octet_length(packed) / 4).cast("bigint")
