"""Source divergence audit over collapsed duplicate texts (operator 13).

How far apart are the sources of a language in their words?  Identical texts of a
language are grouped first: the text is kept once, with how often each source
holds it.  Each kept text is cut into terms once, and its counts enter the counts of
a (language, source, term) as often as that source holds the text; document
frequencies likewise.  What is left is a sparse table of (language, term) rows with the
sources that use the term.

Every (language, source) group, and each language, gives each kept term the smoothed
share p = 1 + floor(SCALE * (count + 2) / (N + 2V)); two shares differ by
f = floor((p - q)**2 / (p + q)).  The divergence of two sources sums f over all V kept
terms, those that neither uses included.  It is found from the sparse rows alone: a source
has one share p0 for all terms that it lacks, so

    sum = V f(p0, q0) + sum over the terms of the first of f(p, q0) - f(p0, q0)
                      + the same for the second
                      + sum over shared terms of f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)

The middle sums go by how many terms have a share (few values), the last one pairs
sources within a term in whole-number numpy and leaves the task as sums per pair of
sources.  All arithmetic is exact.

Defined cases: a null text, language or source is the empty string; a text
without terms, or an empty one, still makes its group occur; repeated rows count each; a language without a
kept term has divergence 0 between its sources and no term rows; an empty table
gives no rows.  Columns other than the three named ones are not read.

Bounds: a task holds at most FLUSH counts beyond one text's, and one list of the sources of a
term; the result itself has a row per pair of sources of a language.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import land, text_slices

MIN_DOCS, TOP = 10, 10
#: Shares are whole multiples of 1 / SCALE.
SCALE = 1_000_000_000
#: Counts that a task gathers before it hands them on, and pairs that are looked at together.
FLUSH, PAIRS_AT_ONCE = 400_000, 1_000_000
#: Bytes of a term: ASCII letters, folded to lower case, and all of a non-ASCII character; others part terms.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(_TABLE).split()


def collapse(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, text, copies): each different text of a language once, copies being its (source, n)."""
    def filled(c):
        return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))

    rows = docs.select(filled(lang_col).alias("lang"), filled(source_col).alias("source"),
                       filled(text_col).alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))
    # counted per source before a text's sources come together: at most one entry per source
    copies = (rows.groupBy("lang", "digest", "source").agg(F.count(F.lit(1)).alias("n"))
              .groupBy("lang", "digest").agg(F.collect_list(F.struct("source", "n")).alias("copies")))
    texts = rows.groupBy("lang", "digest").agg(F.first("text").alias("text"))
    return texts.join(copies, ["lang", "digest"]).select("lang", "text", "copies")


class _Counts:
    """Weighted counts and document frequencies per (lang, source) and term."""

    def __init__(self):
        self.by, self.size = {}, 0

    def add(self, lang: str, words: list[bytes], copies: list[dict]) -> None:
        for c in copies:
            count, df = self.by.setdefault((lang, c["source"]), (Counter(), Counter()))
            before = len(count)
            if c["n"] == 1:
                count.update(words)
                df.update(set(words))
            else:
                for w, k in Counter(words).items():
                    count[w] += k * c["n"]
                    df[w] += c["n"]
            self.size += len(count) - before

    def batches(self):
        for (lang, source), (count, df) in self.by.items():
            if count:
                words = list(count)
                n = len(words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()),
                     pa.array(words, pa.binary()).cast(pa.string()), pa.array(list(count.values()), pa.int64()),
                     pa.array([df[w] for w in words], pa.int64())], names=["lang", "source", "term", "n", "df"])
        self.by, self.size = {}, 0


def term_counts(texts: DataFrame) -> DataFrame:
    """Partial (lang, source, term, n, df) of a table of ``collapse``; sum them up."""
    def run(batches):
        counts = _Counts()
        for batch in batches:
            for rows, strings in text_slices(batch, "text"):
                langs, copies = rows.column("lang").to_pylist(), rows.column("copies").to_pylist()
                for lang, t, c in zip(langs, strings, copies):
                    counts.add(lang, terms_of(t), c)
                    if counts.size > FLUSH:
                        yield from counts.batches()
        yield from counts.batches()

    return texts.mapInArrow(run, "lang string, source string, term string, n bigint, df bigint")


def _share(n: Column, total: Column, v: Column) -> Column:
    """1 + floor(SCALE (n + 2) / (total + 2 v)) in exact decimals; null where there are no terms."""
    top = (n + 2).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    whole = F.call_function("div", top, F.greatest(total + 2 * v, F.lit(1)).cast("decimal(20,0)"))
    return F.when(v > 0, whole.cast("bigint") + 1)


def _gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _shared_terms(shares: DataFrame) -> DataFrame:
    """(lang, a, b, value) partial sums over terms that sources a < b share."""
    schema = "lang string, a string, b string, value bigint"

    def out(sums: dict) -> pa.RecordBatch:
        lang, a, b = zip(*sums)
        return pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in (lang, a, b)]
                                          + [pa.array(list(sums.values()), pa.int64())],
                                          names=["lang", "a", "b", "value"])

    def run(batches):
        sums: dict = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column("uses")
            flat = lists.flatten()
            length = np.asarray(lists.value_lengths())
            names, source = np.unique(np.array(flat.field("source").to_pylist(), object), return_inverse=True)
            p, p0 = (flat.field(k).to_numpy() for k in ("p", "p0"))
            langs, lang = np.unique(np.array(batch.column("lang").to_pylist(), object), return_inverse=True)
            row = np.repeat(np.arange(len(length)), length)
            order = np.lexsort((source, row))
            source, p, p0 = source[order], p[order], p0[order]
            # the element at a place meets all later ones of its row
            later = np.repeat(np.cumsum(length), length) - np.arange(len(row)) - 1
            upto = np.cumsum(later)
            at = 0
            while at < len(row):
                end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS_AT_ONCE, "right")))
                k = later[at:end]
                i = np.repeat(np.arange(at, end), k)
                j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(k) - k, k)
                gain = (_gaps(p[i], p[j]) - _gaps(p[i], p0[j]) - _gaps(p0[i], p[j]) + _gaps(p0[i], p0[j]))
                key = (lang[row[i]] * len(names) + source[i]) * len(names) + source[j]
                found, where = np.unique(key, return_inverse=True)
                total = np.zeros(len(found), np.int64)
                np.add.at(total, where, gain)
                for f, t in zip(found.tolist(), total.tolist()):
                    rest, b = divmod(f, len(names))
                    la, a = divmod(rest, len(names))
                    name = (langs[la], names[a], names[b])
                    sums[name] = sums.get(name, 0) + t
                at = end
            if len(sums) > FLUSH:
                yield out(sums)
                sums = {}
        if sums:
            yield out(sums)

    lists = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "p0")).alias("uses"))
    return lists.filter(F.size("uses") > 1).select("lang", "uses").mapInArrow(run, schema)


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` holds the divergence of a source from each other source
    of its language, part ``term`` the ``top`` terms that a source uses more than its language does."""
    def filled(c):
        return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))

    partial = term_counts(collapse(docs, text_col, lang_col, source_col))
    # one shuffle by (lang, term): the sums per source and the row of a term need no other
    rows = (partial.repartition("lang", "term").groupBy("lang", "term", "source")
            .agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
            .groupBy("lang", "term").agg(F.sum("n").alias("all_n"), F.sum("df").alias("all_df"),
                                         F.collect_list(F.struct("source", "n")).alias("uses")))
    kept = land(rows.filter(F.col("all_df") >= min_docs).select("lang", "term", "all_n", "uses"), "divergence-terms")
    use = kept.select("lang", "term", "all_n", F.inline("uses"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("all_n").alias("lang_n"))
    zero = F.lit(0).cast("bigint")
    groups = (docs.select(filled(lang_col).alias("lang"), filled(source_col).alias("source")).distinct()
              .join(use.groupBy("lang", "source").agg(F.sum("n").alias("source_n")), ["lang", "source"], "left")
              .join(langs, "lang", "left").fillna(0, ["source_n", "v", "lang_n"])
              .withColumn("p0", _share(zero, F.col("source_n"), F.col("v"))))
    groups = land(groups, "divergence-groups")
    shares = land(use.join(groups, ["lang", "source"]).select(
        "lang", "term", "source", "p0", _share(F.col("n"), F.col("source_n"), F.col("v")).alias("p"),
        _share(F.col("all_n"), F.col("lang_n"), F.col("v")).alias("q")), "divergence-shares")

    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    term = (shares.filter(F.col("p") > F.col("q"))
            .select("lang", "source", F.col("term").alias("item"), _gap(F.col("p"), F.col("q")).alias("value"))
            .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top))

    b = groups.select("lang", F.col("source").alias("b"), F.col("p0").alias("q0"))
    absent = groups.join(b, "lang").filter(F.col("source") != F.col("b")).select(
        "lang", F.col("source").alias("a"), "b",
        F.coalesce(F.col("v") * _gap(F.col("p0"), F.col("q0")), zero).alias("value"))
    levels = shares.groupBy("lang", "source", "p", "p0").agg(F.count(F.lit(1)).alias("n"))
    own = (levels.join(b, "lang").filter(F.col("source") != F.col("b"))
           .withColumn("value", F.col("n") * (_gap(F.col("p"), F.col("q0")) - _gap(F.col("p0"), F.col("q0"))))
           .groupBy("lang", F.col("source").alias("a"), "b").agg(F.sum("value").alias("value")))
    one_way = own.unionByName(_shared_terms(shares).groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    both = one_way.unionByName(one_way.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    pair = (absent.unionByName(both).groupBy("lang", F.col("a").alias("source"), F.col("b").alias("item"))
            .agg(F.sum("value").alias("value")).withColumn("rank", F.row_number().over(best)))

    cols = ["lang", "source", "part", "item", "value", "rank"]
    return (pair.withColumn("part", F.lit("pair")).select(cols)
            .unionByName(term.withColumn("part", F.lit("term")).select(cols)))
