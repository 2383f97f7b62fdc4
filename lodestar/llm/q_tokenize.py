"""op1, op2 and op8: token counts, token files, BPE."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from lodestar.llm import bpe_tree, huffman, unigram_count
from lodestar.llm.common import read_table
from lodestar.llm.registry import query
from lodestar.session import scratch_path


@query("op1_token_counts")
def op1_token_counts(spark, sf_dir):
    vocab = unigram_count.sentencepiece_vocab(public_tokenizers.path("piece_bpe_32k.model"))
    return unigram_count.count_tokens(read_table(spark, sf_dir, "documents"), vocab, keep=["doc_id"])


@query("op2_token_files")
def op2_token_files(spark, sf_dir):
    path = scratch_path(spark, "token-files")
    docs = read_table(spark, sf_dir, "documents")
    huffman.write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return huffman.read_tokens(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op8_bpe_roundtrip")
def op8_bpe_roundtrip(spark, sf_dir):
    file = public_tokenizers.path("word_bpe_49k.json")
    both = bpe_tree.round_trip(read_table(spark, sf_dir, "documents"), file, keep=["doc_id"])
    return both.select("doc_id", bpe_tree.n_ids(F.col("ids")).alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
