"""Token-id files under a canonical length-limited Huffman code (operator 2).

``write_tokens`` encodes texts with a tokenizer file, counts all ids, derives
one code from the global counts and writes

* ``codebook``: (id, n, length).  Codes are canonical: ascending (length, id).
* ``blocks``: whole documents in ascending doc_id order, one row per block of
  about ``BLOCK`` ids.  Every block is decoded by itself: its bits start at a
  32-bit boundary and ``checkpoints`` holds the bit offset of every
  ``SEGMENT``-th id, so the segments of many blocks are decoded side by side.

The ids are kept once as a packed table (so a text is encoded once and a lost
task re-reads), put in order by a range shuffle, and coded in the range's task.
The codebook has at most one row per vocabulary entry, the block starts one per
file; only those two reach the driver.

Null texts are empty texts: only ``end_id``.  Rows with equal doc_id follow one another
in an order fixed by their ids' crc; rows with null doc_id come first.  An empty
table gives an empty codebook and no block.  Other columns are not stored.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm.bpe_tree import byte_symbols
from lodestar.llm.common import map_texts, text_slices
from lodestar.llm.wordcache import LONGEST
from lodestar.session import scratch_path, shuffle_partitions

#: Longest code in bits (a code table of 2**20 entries), ids per checkpoint, ids per block.
MAX_BITS, SEGMENT, BLOCK = 20, 256, 65_536
#: Text that is cut into chunks at a time: more of it repeats words within the slice.
ENCODE_BYTES = 8 << 20
#: Bytes of pieces and their ids that a worker remembers before it starts afresh: some million pieces.
KNOWN_BYTES = 32 << 20
#: Ids that are decoded side by side at most, beside a single larger block.
DECODE_IDS = 1 << 21

_BLOCKS = ("part int, block int, start_in_part long, n long, bits binary, checkpoints binary, "
           "doc_ids array<bigint>, doc_n array<bigint>")


# -- tokenizer ---------------------------------------------------------------------------------
class LibraryEncoder:
    """The tokenizers library over whole texts, each different piece encoded once per worker.

    A byte-level pre-tokenizer never joins a non-space with a following space, a line feed with a
    following letter, or a letter with a following mark.  Texts are cut at such places, all texts of a slice
    together in numpy; Arrow tells the different pieces apart, which alone are looked up or encoded,
    and puts their ids in the order of the texts by one ``take``.  Texts that hold an added token, or white space
    that the library and ASCII do not see alike, go whole through the library.
    """

    #: White space beyond ASCII, and ASCII separators that are white space to some.
    _odd = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
    #: Kinds of bytes; 0xFF, which no text has, stands between texts.
    _space, _letter, _mark = (np.isin(np.arange(256), np.frombuffer(x, np.uint8)) for x in (
        b" \t\n\r\x0b\x0c\xff", b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", b".,;:!?\"#$%&*|<>()[]{}=+/-"))

    #: ASCII letters and the bytes of U+00C0 to U+023F, all letters but two.
    _latin = _letter | np.isin(np.arange(256), [*range(0x80, 0xC0), *range(0xC3, 0xC9)])

    def __init__(self, raw: bytes, end_id: int | None):
        from tokenizers import Tokenizer, pre_tokenizers

        self.lib = Tokenizer.from_str(raw.decode())
        self.lib.no_truncation()
        self.lib.no_padding()
        vocab = self.lib.get_vocab(with_added_tokens=False)
        self.added = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.size = max([*vocab.values(), end_id or 0, *self.lib.get_added_tokens_decoder()]) + 1
        self.dtype = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self.bytes_of = np.zeros(self.size, np.int64)
        for t, i in vocab.items():
            self.bytes_of[i] = len(t)  # byte-level: one character per byte
        self.by_chunk = type(self.lib.pre_tokenizer).__name__ == "ByteLevel" and self.lib.normalizer is None
        if self.by_chunk:
            self.signs = dict(enumerate(byte_symbols())) | {10: " "}
            self.words = Tokenizer(self.lib.model)
            self.words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.end = b"" if end_id is None else np.array([end_id], self.dtype).tobytes()
        self.known = self.gap = (pa.array([b"\xff"], pa.binary()), pa.array([b""], pa.binary()))  # pieces, their ids

    def _pack(self, enc) -> bytes:
        return np.array(enc.ids, self.dtype).tobytes()

    def _plain(self, texts: list[str]) -> list[bytes]:
        return [self._pack(e) for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def _cut(self, data: np.ndarray) -> np.ndarray:
        """Starts of the pieces of texts that are joined, each followed by 0xFF."""
        space, mark, gap = self._space[data], self._mark[data], data == 255
        letter = self._letter[data]
        start = np.zeros(len(data) + 1, bool)
        start[0] = True
        start[:-1] |= gap
        start[1:] |= gap
        start[1:-1] |= space[1:] & ~space[:-1]  # white space after other characters
        # marks after a letter, if nothing but marks comes before the next white space
        at = np.arange(len(data), dtype=np.int32)
        other = np.minimum.accumulate(np.where(mark, np.int32(len(data)), at)[::-1])[::-1]  # the text ends with a gap
        first = np.flatnonzero(mark[1:] & letter[:-1]) + 1
        start[first[space[other[first]]]] = True
        # a line feed between another character and a letter
        feed = np.flatnonzero((data[1:-1] == 10) & ~space[:-2] & letter[2:]) + 1
        start[feed + 1] = True
        return np.flatnonzero(start)

    def _encode_joined(self, texts: list[bytes]) -> list[bytes]:
        if not texts:
            return []
        raw = b"\xff".join([*texts, b""])
        starts = self._cut(np.frombuffer(raw, np.uint8)).astype(np.int32)
        arr = pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(raw)])
        enc = arr.dictionary_encode()
        have, at = self._ids_of(enc.dictionary)
        ids = have.take(pa.array(at[enc.indices.to_numpy()]))
        offsets = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset:ids.offset + len(ids) + 1]
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(size + 1)  # a text's pieces are those between its start and its gap
        a, b = (offsets[np.searchsorted(starts, x)].tolist() for x in (ends - size - 1, ends - 1))
        out = memoryview(ids.buffers()[2]) if ids.buffers()[2] is not None else memoryview(b"")
        return [bytes(out[i:j]) for i, j in zip(a, b)]

    def _ids_of(self, pieces: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Packed ids, and the place among them of each of the different pieces; new ones are encoded and remembered."""
        at = pc.fill_null(pc.index_in(pieces, value_set=self.known[0]), -1).to_numpy().copy()
        new = at < 0
        at[new] = len(self.known[0]) + np.arange(np.count_nonzero(new), dtype=at.dtype)
        fresh = pieces.filter(pa.array(new))
        made = self._encode_pieces(fresh)
        have = pa.concat_arrays([self.known[1], made])
        short = pc.less_equal(pc.binary_length(fresh), LONGEST)
        full = sum(x.nbytes for x in self.known) > KNOWN_BYTES
        first = self.gap if full else self.known  # it starts afresh with those new in this slice
        self.known = tuple(pa.concat_arrays([x, y.filter(short)]) for x, y in zip(first, (fresh, made)))
        return have, at

    def _encode_pieces(self, pieces: pa.Array) -> pa.Array:
        """Words of Latin letters, with or without a space before, are one pre-token each and go
        straight to the library's model; everything else takes the library's full way."""
        if not len(pieces):
            return pieces
        word = self._words_among(pieces)
        words, rest = pieces.filter(pa.array(word)), pieces.filter(pa.array(~word))
        ids = pa.concat_arrays([self._encode_words(words), pa.array(self._plain(rest.cast(pa.string()).to_pylist()), pa.binary())])
        at = np.where(word, np.cumsum(word) - 1, len(words) + np.cumsum(~word) - 1)
        return ids.take(pa.array(at))

    @staticmethod
    def _bytes_of(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of a binary array without nulls, and the start of each value and the end."""
        offsets = np.frombuffer(arr.buffers()[1], np.int32)[arr.offset:arr.offset + len(arr) + 1]
        return np.frombuffer(arr.buffers()[2], np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]

    def _words_among(self, pieces: pa.Array) -> np.ndarray:
        data, offsets = self._bytes_of(pieces)
        fits = self._latin[data]
        fits[:-1] &= ~((data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7)))  # the signs of times and division
        start = offsets[:-1]
        fits[start[(data[start] == 32) & (np.diff(offsets) > 1)]] = True
        return np.logical_and.reduceat(fits, start)

    def _encode_words(self, words: pa.Array) -> pa.Array:
        n = len(words)
        if not n:
            return words
        data, offsets = self._bytes_of(words)
        text = np.full(len(data) + n, 10, np.uint8)  # a line feed after each word
        letter = np.ones(len(text), bool)
        letter[offsets[1:] + np.arange(n)] = False
        text[letter] = data
        ids = []
        for a in range(0, n, 2000):
            b = min(n, a + 2000)
            part = text[offsets[a] + a:offsets[b] + b - 1].tobytes().decode("latin-1").translate(self.signs)
            ids.append(np.array(self.words.encode_batch_fast([part], add_special_tokens=False)[0].ids, self.dtype))
        ids = np.concatenate(ids)
        ends = np.searchsorted(np.cumsum(self.bytes_of[ids]), offsets[1:]) + 1
        at = (self.dtype.itemsize * np.concatenate([[0], ends])).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(at), pa.py_buffer(ids)])

    def encode(self, texts: list) -> list[bytes]:
        texts = [t or "" for t in texts]
        if not self.by_chunk:
            return [ids + self.end for ids in self._plain(texts)]
        whole = "\n".join(texts)
        strange = [a for a in self.added if a in whole], self._odd.search(whole)  # mostly neither
        odd = {k for k, t in enumerate(texts) if any(a in t for a in strange[0]) or self._odd.search(t)} if any(strange) else ()
        plain = iter(self._encode_joined([t.encode() for k, t in enumerate(texts) if k not in odd]))
        rest = iter(self._plain([texts[k] for k in sorted(odd)]))
        return [next(rest if k in odd else plain) + self.end for k in range(len(texts))]


@lru_cache(maxsize=2)
def _encoder(raw: bytes, end_id: int | None) -> LibraryEncoder:
    return LibraryEncoder(raw, end_id)


# -- code --------------------------------------------------------------------------------------
def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge); 0 for ids that never occur."""
    ids = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    n = len(ids)
    if n > 1 << limit:
        raise ValueError(f"{n} ids need codes of more than {limit} bits")
    if n < 2:
        out[ids] = 1
        return out
    order = ids[np.argsort(counts[ids], kind="stable")]
    w = counts[order].astype(np.int64)
    level, leaf = w, [np.ones(n, bool)]
    for _ in range(limit - 1):
        m = len(level) // 2 * 2
        both = np.concatenate([w, level[0:m:2] + level[1:m:2]])
        by = np.argsort(both, kind="stable")
        leaf.append(by < n)
        level = both[by]
    lens, take = np.zeros(n, np.uint8), 2 * n - 2
    for flags in reversed(leaf):
        k = int(flags[:take].sum())
        lens[:k] += 1
        take = 2 * (take - k)
    out[order] = lens
    return out


class Code:
    """Canonical code of given lengths."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.uint64)
        ids = np.flatnonzero(lengths)
        ids = ids[np.argsort(lengths[ids], kind="stable")]
        lens = lengths[ids].astype(np.int64)
        self.bits = int(lens.max()) if len(ids) else 1
        span = np.left_shift(1, self.bits - lens)  # table entries of each code
        first = np.cumsum(span) - span
        self.codes = np.zeros(len(lengths), np.uint64)
        self.codes[ids] = (first >> (self.bits - lens)).astype(np.uint64)
        self.symbol = np.zeros(1 << self.bits, np.uint32)
        self.length = np.ones(1 << self.bits, np.uint8)
        end = int(span.sum())
        self.symbol[:end] = np.repeat(ids, span)
        self.length[:end] = np.repeat(lens, span)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bits (32-bit words, big-endian) and the bit offset of every SEGMENT-th id."""
        if not len(ids):
            return b"", np.zeros(0, "<u4")
        lens = self.lengths[ids]
        if not lens.all():
            raise ValueError("an id without a code")
        ends = np.cumsum(lens)
        pos = ends - lens
        value = self.codes[ids] << (64 - lens - (pos & 31))
        word = (pos >> 5).astype(np.int64)
        cut = np.concatenate([[0], np.flatnonzero(np.diff(word)) + 1])
        out = np.zeros(int(ends[-1] + 31) // 32 + 1, np.uint64)
        at = word[cut]
        out[at] += np.add.reduceat(value >> 32, cut)
        out[at + 1] += np.add.reduceat(value & 0xFFFFFFFF, cut)
        return out[:-1].astype(">u4").tobytes(), pos[::SEGMENT].astype("<u8")

    def decode(self, bits: list[bytes], checkpoints: list[bytes], counts: list[int]) -> np.ndarray:
        """Ids of several blocks in turn; all their segments advance together, one id a step."""
        sizes = np.array([len(b) for b in bits], np.int64)
        data = np.frombuffer(b"".join(bits) + b"\0" * 8, np.uint8).astype(np.uint32)
        peek = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
        marks = [np.frombuffer(c, "<u8").astype(np.int64) for c in checkpoints]
        base = 8 * (np.cumsum(sizes) - sizes)
        pos = np.concatenate([m + b for m, b in zip(marks, base.tolist())] or [np.zeros(0, np.int64)])
        todo = np.concatenate([np.minimum(SEGMENT, n - SEGMENT * np.arange(len(m)))
                               for m, n in zip(marks, counts)] or [np.zeros(0, np.int64)])
        order = np.argsort(-todo, kind="stable")
        pos, left = pos[order], todo[order]
        out = np.zeros((len(pos), SEGMENT), np.uint32)
        shift = np.uint32(32 - self.bits)
        active = np.searchsorted(-left, -np.arange(SEGMENT), side="left")  # lanes that still have an id at each step
        for step in range(SEGMENT):
            k = int(active[step])
            if not k:
                break
            p = pos[:k]
            at = (peek[p >> 3] << (p & 7).astype(np.uint32)) >> shift
            out[:k, step] = self.symbol[at]
            p += self.length[at]
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return out[back][np.arange(SEGMENT) < todo[:, None]]


@lru_cache(maxsize=2)
def _code(lengths: bytes) -> Code:
    return Code(np.frombuffer(lengths, np.uint8))


# -- files -------------------------------------------------------------------------------------
def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int | None = None,
                 id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> None:
    spark = docs.sparkSession
    with open(tokenizer_path, "rb") as f:  # the tokenizer's file lies with the driver, a few MB
        raw = spark.sparkContext.broadcast(f.read())
    enc = _encoder(raw.value, end_id)
    size, dtype = enc.size, enc.dtype

    def make_encode():
        e = _encoder(raw.value, end_id)
        return lambda texts: [pa.array(e.encode(texts), pa.binary())]

    staged = scratch_path(spark, "llm-token-ids")
    (map_texts(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")),
               "text", ["doc_id"], "ids binary", make_encode, slice_bytes=ENCODE_BYTES)
     .write.option("compression", "zstd").parquet(staged))
    ids = spark.read.schema("doc_id bigint, ids binary").parquet(staged)

    def count(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for _, packed in text_slices(batch, "ids"):
                total += np.bincount(np.frombuffer(b"".join(packed), dtype), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["id", "n"])

    counted = ids.select("ids").mapInArrow(count, "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(size, np.int64)
    for r in counted.collect():  # one row per vocabulary entry at most
        counts[r["id"]] = r["n"]
    lengths = code_lengths(counts, max_bits)
    used = np.flatnonzero(lengths)
    spark.createDataFrame([(int(i), int(counts[i]), int(lengths[i])) for i in used],
                          "id int, n bigint, length int").coalesce(1).write.parquet(f"{path}/codebook")

    shared = spark.sparkContext.broadcast(lengths.tobytes())

    def blocks(batches):
        code = _code(shared.value)
        part, block, start, held, have = 0, 0, 0, [], 0

        def flush():
            nonlocal block, start, held, have
            ids = np.frombuffer(b"".join(p for _, p in held), dtype)
            bits, marks = code.encode(ids)
            row = [[part], [block], [start], [len(ids)], [bits], [marks.tobytes()], [[d for d, _ in held]],
                   [[len(p) // dtype.itemsize for _, p in held]]]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(),
                     pa.list_(pa.int64()), pa.list_(pa.int64())]
            names = ["part", "block", "start_in_part", "n", "bits", "checkpoints", "doc_ids", "doc_n"]
            block, start, held, have = block + 1, start + len(ids), [], 0
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], names)

        for batch in batches:
            for rows, packed in text_slices(batch, "ids"):
                if rows.num_rows:
                    part = rows.column(1)[0].as_py()
                for d, p in zip(rows.column(0).to_pylist(), packed):
                    held.append((d, p))
                    have += len(p) // dtype.itemsize
                    if have >= BLOCK:
                        yield flush()
        if held:
            yield flush()

    ordered = (ids.withColumn("crc", F.crc32("ids"))
               .repartitionByRange(shuffle_partitions(spark), "doc_id", "crc").sortWithinPartitions("doc_id", "crc"))
    (ordered.select("doc_id", F.spark_partition_id().alias("part"), "ids").mapInArrow(blocks, _BLOCKS)
     .write.option("compression", "none").parquet(f"{path}/blocks"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): ids as little-endian unsigned 32-bit integers."""
    book = spark.read.schema("id int, n bigint, length int").parquet(f"{path}/codebook").collect()
    lengths = np.zeros(max([r["id"] for r in book], default=0) + 1, np.uint8)
    for r in book:
        lengths[r["id"]] = r["length"]
    shared = spark.sparkContext.broadcast(lengths.tobytes())
    table = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    sizes = {r["part"]: r["n"] for r in table.groupBy("part").agg(F.sum("n").alias("n")).collect()}  # one per file
    starts, at = {}, 0
    for part in sorted(sizes):
        starts[part] = at
        at += sizes[part]

    def decode(batches):
        code = _code(shared.value)
        for batch in batches:
            n = batch.column(3).to_numpy()
            group = (np.cumsum(n) // DECODE_IDS).tolist()
            cuts = [0, *(i for i in range(1, len(group)) if group[i] != group[i - 1]), len(group)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                part, _, first, n_ids, bits, marks, doc_ids, doc_n = (c.to_pylist() for c in batch.slice(a, b - a))
                ids = code.decode(bits, marks, n_ids).astype("<u4")
                per_doc = np.concatenate([np.array(x, np.int64) for x in doc_n])
                start = np.concatenate([starts[p] + s + np.cumsum(x) - np.array(x, np.int64)
                                        for p, s, x in zip(part, first, doc_n)])
                offsets = 4 * np.concatenate([[0], np.cumsum(per_doc)])
                packed = pa.Array.from_buffers(pa.large_binary(), len(per_doc), [
                    None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(ids)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d for x in doc_ids for d in x], pa.int64()), pa.array(start), pa.array(per_doc), packed],
                    ["doc_id", "start", "n_tokens", "ids"])

    return table.mapInArrow(decode, "doc_id bigint, start bigint, n_tokens bigint, ids binary")
