"""Operators 1, 2 and 8 against the libraries, with awkward rows."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from lodestar.llm import bpe_tree, huffman, q_tokenize, unigram_count
from lodestar.session import scratch_path
from tests.conftest import SF_SMALL
from tests.llm.edge import ROWS, documents, folder, text_of

ODD = ["Á ΑΣ ΣΑΣ İI ß ſ K <|endoftext|>foo's'S 12aͅ", "x\x1cy\x85z᠎w​q", "ᾳ ǅ ﬁ ㎏ 한국 \u0000 a\tb",
       "<|startoftext|>", "", "  ", "a" * 500 + "é" * 100, "x<|endoftext|>y <|startoftext|", "1234 ½²ⅣⅫ",
       "don't I'LL we'Re ''s", "ab́c ́x", "𝄞𝕏 a̐éö̲", "  two  spaces   three\n\n\n x \n", None]


def library(name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.no_truncation()
    t.no_padding()
    return t


def unigram_library(vocab, **kw):
    t = Tokenizer(models.Unigram(vocab, unk_id=0, **kw))
    t.pre_tokenizer = pre_tokenizers.Metaspace()
    return t


def test_unigram_counts_equal_library_on_odd_texts():
    vocab = unigram_count.sentencepiece_vocab(public_tokenizers.path("piece_bpe_32k.model"))
    lib, own = unigram_library(vocab, byte_fallback=True), unigram_count.Counter(tuple(vocab))
    texts = ODD + ["▁▁x▁", "<0x41><s> <unk>", "😀😀 a😀b", "x" * 3000, " lead", "trail "]
    assert own.count(texts) == [len(lib.encode(text_of(t)).ids) for t in texts]


@pytest.mark.parametrize("scores", [(-1.0, -1.0, -2.0, -2.0, -3.0, -1.0, -2.0, -1.5), (-1.0,) * 8,
                                    (0.0, -1.0, -1.0, 0.0, -0.5, -2.0, -2.0, -3.0)])
def test_unigram_ties(scores):
    vocab = [("<unk>", 0.0), *zip(["a", "b", "ab", "ba", "aba", "▁", "▁a", "bb"], scores)]
    lib, own = unigram_library(vocab), unigram_count.Counter(tuple(vocab))
    rng = random.Random(1)
    for _ in range(1500):
        s = "".join(rng.choice("abbac xz") for _ in range(rng.randint(0, 14)))
        assert own.count([s]) == [len(lib.encode(s).ids)], s


def test_op1_whole_table(spark):
    vocab = unigram_count.sentencepiece_vocab(public_tokenizers.path("piece_bpe_32k.model"))
    lib = unigram_library(vocab, byte_fallback=True)
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = {r["doc_id"]: r["n_tokens"] for r in q_tokenize.op1_token_counts(spark, SF_SMALL).collect()}
    assert got == {i: len(lib.encode(t).ids) for i, t in docs.items()}


def want_files(rows, lib):
    out, at = [], 0
    packed = sorted(((-1 if i is None else i), np.array(lib.encode(text_of(t), add_special_tokens=False).ids + [2],
                                                        "<u4").tobytes()) for i, t, *_ in rows)
    small = sorted(packed, key=lambda x: (x[0], zlib.crc32(np.frombuffer(x[1], "<u4").astype("<u2").tobytes())))
    for i, b in small:
        out.append((None if i < 0 else i, at, len(b) // 4, zlib.crc32(b)))
        at += len(b) // 4
    return out


def test_op2_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in q_tokenize.op2_token_files(spark, SF_SMALL).collect())
    assert got == want_files(rows, library("byte_bpe_50k.json"))


def test_op2_awkward_rows_and_round_trip(spark, tmp_path, monkeypatch):
    rows = ROWS + [(20 + k, t, None, None) for k, t in enumerate(ODD)]
    lib = library("byte_bpe_50k.json")
    want = want_files(rows, lib)
    key = lambda r: (-1 if r[0] is None else r[0], r[1])
    assert sorted((tuple(r) for r in q_tokenize.op2_token_files(spark, folder(spark, tmp_path, rows)).collect()),
                  key=key) == want
    path = scratch_path(spark, "t-files")
    huffman.write_tokens(documents(spark, rows), path, public_tokenizers.path("byte_bpe_50k.json"))
    ids = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in huffman.read_tokens(spark, path).collect()}
    assert ids[4] == lib.encode(rows[4][1], add_special_tokens=False).ids and ids[1] == []


def test_op2_added_tokens_stay_whole(spark, tmp_path):
    texts = ["<|endoftext|>", "x <|endoftext|>", "<|endoftext|>.", "foo <|endoftext|> bar", "\n<|endoftext|>", "x\n<|endoftext|>!)",
             "a<|endoftext|><|endoftext|>", "\n\n <|endoftext|>  \n", "<|endoftext", "plain. <|endoftext|>, plain."]
    rows = [(k, t, None, None) for k, t in enumerate(texts)]
    lib = library("byte_bpe_50k.json")
    assert sorted(tuple(r) for r in q_tokenize.op2_token_files(spark, folder(spark, tmp_path, rows)).collect()
                  ) == want_files(rows, lib)
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        own = huffman.LibraryEncoder(f.read(), None)
    assert [np.frombuffer(b, own.dtype).tolist() for b in own.encode(texts)] == [
        lib.encode(t, add_special_tokens=False).ids for t in texts]


def test_op2_empty_table(spark, tmp_path):
    assert q_tokenize.op2_token_files(spark, folder(spark, tmp_path, [])).count() == 0


def test_code_lengths_are_optimal_and_limited():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 17, 300):
        counts = np.zeros(400, np.int64)
        counts[rng.choice(400, n, replace=False)] = rng.integers(1, 50, n)
        lens = huffman.code_lengths(counts, 20)
        assert (lens[counts == 0] == 0).all() and (lens[counts > 0] > 0).all()
        used = lens[lens > 0].astype(float)
        assert (2.0 ** -used).sum() <= 1
        import heapq

        heap, total = sorted(counts[counts > 0].tolist()), 0
        while len(heap) > 1:
            s = heapq.heappop(heap) + heapq.heappop(heap)
            total += s
            heapq.heappush(heap, s)
        assert (lens * counts).sum() == (total or counts.sum())
    fib = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144, 233, 377])
    assert huffman.code_lengths(fib, 5).max() == 5
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(9, np.int64), 3)


def test_blocks_decode_alone_and_together():
    rng = np.random.default_rng(1)
    ids = np.minimum(rng.zipf(1.3, 5000), 999)
    counts = np.bincount(ids, minlength=1000)
    code = huffman.Code(huffman.code_lengths(counts))
    parts = [ids[:1], ids[1:257], ids[257:257], ids[257:2000], ids[2000:]]
    enc = [code.encode(p) for p in parts]
    got = code.decode([b for b, _ in enc], [m.tobytes() for _, m in enc], [len(p) for p in parts])
    assert (got == ids).all()
    for p, (b, m) in zip(parts, enc):
        assert (code.decode([b], [m.tobytes()], [len(p)]) == p).all()


def want_bpe(rows, lib):
    out = []
    for i, t, *_ in rows:
        ids = lib.encode(text_of(t), add_special_tokens=False).ids
        out.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                    hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    return sorted(out, key=str)


def test_op8_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in q_tokenize.op8_bpe_roundtrip(spark, SF_SMALL).collect()), key=str)
    assert got == want_bpe(rows, library("word_bpe_49k.json"))


def test_op8_awkward_rows(spark, tmp_path):
    rows = ROWS + [(20 + k, t, None, None) for k, t in enumerate(ODD)]
    d = folder(spark, tmp_path, rows)
    got = sorted((tuple(r) for r in q_tokenize.op8_bpe_roundtrip(spark, d).collect()), key=str)
    assert got == want_bpe(rows, library("word_bpe_49k.json"))
    assert sorted(r["n_tokens"] for r in q_tokenize.op1_token_counts(spark, d).collect())[:3] == [0, 0, 0]


def test_lockstep_and_single_trees_agree():
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as f:
        bpe = bpe_tree.Bpe(f.read())
    rng = random.Random(2)
    words = ["".join(rng.choice("theranoisélw") for _ in range(rng.randint(2, 40))).encode() for _ in range(400)]
    words = [w for w in words if 2 <= len(w) <= 64]
    assert bpe._lockstep(words, 64) == [bpe._one(w) for w in words]


def test_tree_root_is_leftmost_least():
    rng = random.Random(3)
    for n in (1, 2, 5, 8):
        keys = [rng.randint(0, 50) for _ in range(n)]
        tree = bpe_tree.Tree(list(keys), 1 << 30)
        for _ in range(30):
            i, k = rng.randrange(n), rng.randint(0, 50)
            keys[i] = k
            tree.put(i, k)
            assert tree.root() == min(keys)


def test_op1_op8_empty_table(spark, tmp_path):
    d = folder(spark, tmp_path, [])
    assert q_tokenize.op1_token_counts(spark, d).count() == 0
    assert q_tokenize.op8_bpe_roundtrip(spark, d).count() == 0


def test_op2_pieces_equal_the_library_on_mixed_strings():
    """Every kind of border between letters, marks, digits, white space and other scripts."""
    rng = random.Random(0)
    parts = ["a", "Word", " ", "  ", "\n", "\n\n", ".", ",", "!!", "'s", "don't", "é", "ß.", "…,", "日本", "1", "12,", "<|endoftext|>",
             "\t", "\x1c", " ", "\r\n", "###", "x.y", "<", "|", "'", '"', "\xa0", "ŉ", "Ⅷ", "á", "\x00", "$", "\u0085"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(20_000)] + ["", None, " ", "\n", ".", "a" * 70_000]
    lib = library("byte_bpe_50k.json")
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        own = huffman.LibraryEncoder(f.read(), None)
    want = [e.ids for e in lib.encode_batch([text_of(t) for t in texts], add_special_tokens=False)]
    assert [np.frombuffer(b, own.dtype).tolist() for b in own.encode(texts)] == want
    assert own.encode([]) == []


def test_pieces_are_remembered_in_few_bytes_and_start_afresh(monkeypatch):
    """What is known is not encoded again, even 450,000 pieces; beyond the bound the ids stay right."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        raw = f.read()
    lib = library("byte_bpe_50k.json")
    letters = "etaoinsrhl"
    many = [" ".join("".join(letters[int(d)] for d in str(k)) for k in range(a, a + 50_000)) for a in range(0, 450_000, 50_000)]
    own = huffman.LibraryEncoder(raw, None)
    first = own.encode(many)
    monkeypatch.setattr(own, "words", None)  # the library's model, of no more use
    assert own.encode(many) == first
    assert np.frombuffer(first[8], own.dtype).tolist() == lib.encode(many[8], add_special_tokens=False).ids
    monkeypatch.setattr(huffman, "KNOWN_BYTES", 200)
    own = huffman.LibraryEncoder(raw, 2)
    rng = random.Random(5)
    signs = [chr(c) for c in range(0x80, 0x260)]
    for _ in range(60):
        texts = ["".join(rng.choice(["ab", " ", "Z", " cd", "\n", "×", rng.choice(signs)]) for _ in range(rng.randint(0, 30)))
                 for _ in range(20)] + ["w" * 300, "", None]
        assert [np.frombuffer(b, own.dtype).tolist() for b in own.encode(texts)] == [
            lib.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
        assert sum(x.nbytes for x in own.known) < 200 + 20_000
    assert own.encode([c + "a" + c + " b" + c for c in signs]) == [
        np.array(lib.encode(c + "a" + c + " b" + c, add_special_tokens=False).ids + [2], own.dtype).tobytes() for c in signs]
