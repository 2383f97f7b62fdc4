"""Stages of the corpus pipeline, each a function (spark, docs, sf_dir) -> DataFrame.

All but the last return the columns of ``docs``, whatever they are; extra columns pass
through untouched and may have any name: a stage gives its own columns names that ``docs`` lacks.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import bpe_tree, byte_cnn, decontam, secrets, signature_tree
from lodestar.llm.common import fresh, id_text, land, read_table, sent
from lodestar.session import scratch_path, ship_package

#: Probability below which no language is certain enough; with four languages a coin of four sides gives 0.25.
MIN_LANGUAGE_SCORE = 0.4
#: Words of a shingle and the similarity (of 100) from which texts are near-duplicates.
NEAR = (5, 80, 100)
#: Rows of (id, text hash) up to which a list of documents to drop is broadcast, some 50 MB as a join table.
KEYS_SENT = 1 << 20


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter or text, and those that fit no learned language."""
    ship_package(spark)
    net = byte_cnn.fit(docs, F.lit(True))
    lang, score = fresh(docs.columns, "lang_pred", "score")
    known = byte_cnn.predict(docs, net, lang_out=lang, score_out=score)
    return known.filter((F.col(lang) != byte_cnn.UNKNOWN) & (F.col(score) >= MIN_LANGUAGE_SCORE)).select(
        *[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates: that with the smallest doc_id.

    A null doc_id is larger than all others; equal ids go by the text's hash.  Texts that are not linked all
    stay, whatever their ids.  Of repeated rows one stays; documents without words are no duplicates and all stay.
    """
    ship_package(spark)
    per_doc, _ = signature_tree.join(docs, width=NEAR[0], num=NEAR[1], den=NEAR[2])
    words = per_doc.filter(F.col("cls").isNotNull())
    own = fresh(docs.columns, "id_text", "text_hash")
    key = [id_text().alias(own[0]), F.col("text_hash").alias(own[1])]
    chosen = (words.groupBy("root")
              .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("c"))
              .select(id_text("c.doc_id").alias(own[0]), F.col("c.text_hash").alias(own[1])).distinct())
    rows = land(words.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).join(
        chosen.withColumn("stays", F.lit(True)), own, "left"), "near-duplicate-rows")
    gone = land(rows.filter(F.col("stays").isNull()).select(*own), "near-duplicates-gone")
    repeated = land(rows.filter(F.col("stays") & (F.col("n") > 1)).select(*own), "repeated-rows")
    left = docs.withColumn(own[0], id_text()).withColumn(own[1], signature_tree.text_hash(F.col("text"))).join(
        sent(gone, KEYS_SENT), own, "left_anti")
    if repeated.isEmpty():
        return left.drop(*own)
    few = sent(repeated, KEYS_SENT)
    one = left.join(few, own, "left_semi").dropDuplicates(own)
    return left.join(few, own, "left_anti").unionByName(one).drop(*own)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    ship_package(spark)
    return decontam.remove_documents(docs, read_table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by a mark; n_chars follows the text where the column is there."""
    ship_package(spark)
    out = secrets.redact_documents(docs, scratch_path(spark, "secret-ledger"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new = F.char_length("text").cast(kind)
        out = out.withColumn("n_chars", F.when(F.col("text").contains("[SECRET]"), new).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text and the text that they decode to.

    Adds token_ids (little-endian unsigned 32-bit integers), n_tokens and decoded; columns of these
    names are replaced.
    """
    ship_package(spark)
    file = public_tokenizers.path("word_bpe_49k.json")
    new = {"token_ids", "n_tokens", "decoded"}
    keep = [c for c in docs.columns if c not in new]
    both = bpe_tree.round_trip(docs, file, ids_out="token_ids", keep=keep)
    return both.withColumn("n_tokens", bpe_tree.n_ids(F.col("token_ids")))


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate),
          ("redact_secrets", redact_secrets), ("tokenize", tokenize)]
