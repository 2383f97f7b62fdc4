"""Benchmark decontamination by exact n-grams (operator 5); DataFrame functions only.

Words are maximal runs of ASCII letters and digits and of all characters beyond
ASCII, A-Z lower-cased.  Every run of ``n`` consecutive words of a benchmark
item is a window; an item with fewer words, but not none, is one window.  A
document word inside any occurrence of a window is hit.

``scan`` cuts each document into words once.  Its windows of each length are
probed in place, as 64-bit hashes, against the hash set of all benchmark
windows, which travels inside the plan to every task; only positions that pass
become rows, and those are verified by joining on the window's exact text.  The
set is counted first: above ``max_set`` windows the positions are exploded with their hashes and
Spark joins those to the windows' hashes; positions that meet one get their text and are verified
in the same way, with the same result.

Defined cases: a null text has no words; rows equal in id and text share their
findings and each gives a row; equal items and windows shared by items count
for each item; null item texts have no windows, a null item_id is left out of the
list of items; empty tables give no windows or no rows.  Other columns of the
inputs are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import fresh, land, lower_ascii, sent

# Fixed value: what separates words (ASCII other than letters and digits; A-Z are gone by then).
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: Windows up to which their hashes are sent with the plan (8 bytes each, so at most 1.6 MB), and
#: contaminated documents up to which their 64-character keys are broadcast.
MAX_SET = 200_000


def words(text: Column) -> Column:
    """The words of a text (null: none)."""
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS), lambda w: w != "")


def _grams(w: Column, length: int, make) -> Column:
    """``make(start, window words)`` for each run of ``length`` words; starts count from 0."""
    return F.when(F.size(w) >= length,
                  F.transform(F.sequence(F.lit(0), F.size(w) - length),
                              lambda i: make(i, F.slice(w, i + 1, length))))


def windows(benchmark: DataFrame, n: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(len, gram, item_id): the distinct windows of each item."""
    w = benchmark.select(F.col(id_col).cast("string").alias("item_id"), words(F.col(text_col)).alias("w"))
    size = F.least(F.size("w"), F.lit(n))
    return (w.filter(F.size("w") > 0)
            .select("item_id", size.alias("len"), F.explode(F.transform(
                F.sequence(F.lit(0), F.size("w") - size),
                lambda i: F.array_join(F.slice("w", i + 1, size), " "))).alias("gram"))
            .distinct())


def scan(docs: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text",
         max_set: int = MAX_SET) -> tuple[DataFrame, DataFrame]:
    """(per document, hits).

    Per document, one row each: id, key, n_words, n_hit, items (sorted
    item_ids).  Hits: (key, start, len, gram), one row per occurrence.  The key
    stands for (id, text).
    """
    win = land(windows(benchmark, n), "decontam-windows")
    grams = win.select("len", "gram").distinct()
    # lengths are at most n; the number of windows is checked before their hashes are collected
    lengths = sorted(r["len"] for r in win.select("len").distinct().collect())
    n_grams = grams.count()

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # the separators are ASCII, so no word is empty but at the two ends
    base = docs.select(F.col(id_col).alias("id"),
                       F.sha2(F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), text), 256)
                       .alias("key"),
                       words(text).alias("w"))
    # equal hashes are only candidates; the text of the window decides below
    if n_grams <= max_set:
        hashes = {k: [] for k in lengths}
        for r in grams.select("len", F.xxhash64(F.split("gram", " ")).alias("h")).distinct().collect():
            hashes[r["len"]].append(r["h"])
        found = [F.filter(F.coalesce(_grams(F.col("w"), k, lambda i, g, k=k: F.struct(
            i.alias("start"), F.lit(k).alias("len"),
            F.when(F.xxhash64(g).isin(hashes[k]), F.array_join(g, " ")).alias("gram"))),
            F.array().cast("array<struct<start:int,len:int,gram:string>>")),
            lambda x: x["gram"].isNotNull()) for k in lengths]
        cand = F.concat(*found) if found else F.array().cast("array<struct<start:int,len:int,gram:string>>")
        doc = land(base.select("id", "key", F.size("w").cast("bigint").alias("n_words"), cand.alias("cand")),
                   "decontam-docs")
        pos = doc.filter(F.size("cand") > 0).select("key", F.explode("cand").alias("c")).select("key", "c.*")
    else:
        # windows leave as (key, start, len, hash); only those that meet a benchmark window's hash get their text
        doc = land(base, "decontam-docs")
        known = grams.select("len", F.xxhash64(F.split("gram", " ")).alias("h")).distinct()
        spots = doc.select("key", F.explode(F.concat(*[
            F.coalesce(_grams(F.col("w"), k, lambda i, g, k=k: F.struct(
                i.alias("start"), F.lit(k).alias("len"), F.xxhash64(g).alias("h"))),
                F.array().cast("array<struct<start:int,len:int,h:bigint>>")) for k in lengths])).alias("c")
        ).select("key", "c.*").join(known, ["len", "h"], "left_semi")
        spots = land(spots.select("key", "start", "len").distinct(), "decontam-spots")
        pos = spots.join(doc.dropDuplicates(["key"]).select("key", "w"), "key").select(
            "key", "start", "len", F.array_join(F.slice("w", F.col("start") + 1, F.col("len")), " ").alias("gram"))
        doc = doc.select("id", "key", F.size("w").cast("bigint").alias("n_words"))
    hits = land(pos.join(grams, ["len", "gram"], "left_semi").select("key", "start", "len", "gram").distinct(),
                "decontam-hits")
    n_hit = (hits.select("key", F.explode(F.sequence("start", F.col("start") + F.col("len") - 1)).alias("p"))
             .distinct().groupBy("key").agg(F.count(F.lit(1)).alias("n_hit")))
    items = (hits.select("key", "len", "gram").distinct().join(win, ["len", "gram"]).select("key", "item_id")
             .distinct().groupBy("key").agg(F.array_sort(F.collect_list("item_id")).alias("items")))
    none = F.array().cast("array<string>")
    out = (doc.select("id", "key", "n_words").join(n_hit, "key", "left").join(items, "key", "left")
           .select("id", "key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
                   F.coalesce("items", none).alias("items")))
    return out, hits


def remove_documents(docs: DataFrame, benchmark: DataFrame, n: int = 10, max_ratio: float = 0.0,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents whose share of hit words is at most ``max_ratio``, with all their columns.

    A document without words has no hit and stays.
    """
    per_doc, _ = scan(docs, benchmark, n, id_col, text_col)
    bad = land(per_doc.filter(F.col("n_hit") > max_ratio * F.col("n_words")).select("key").distinct(), "contaminated")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.sha2(F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), text), 256)
    own = fresh(docs.columns, "text_key")[0]
    return docs.withColumn(own, key).join(sent(bad.withColumnRenamed("key", own), MAX_SET), own, "left_anti").drop(own)


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, clean): each document's words without the hit ones, joined by single spaces."""
    _, hits = scan(docs, benchmark, n, id_col, text_col)
    pos = (hits.select("key", F.explode(F.sequence("start", F.col("start") + F.col("len") - 1)).alias("p"))
           .distinct().groupBy("key").agg(F.array_sort(F.collect_list("p")).alias("bad")))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.sha2(F.concat_ws(
        "|", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), text), 256).alias("key"))
    j = base.join(pos, "key", "left").withColumn("w", words(F.col("text")))
    good = F.when(F.col("bad").isNull(), F.col("w")).otherwise(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size("w") - 1), F.col("bad")), lambda i: F.get(F.col("w"), i)))
    return j.select("id", F.array_join(good, " ").alias("clean"))
