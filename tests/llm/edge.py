"""A small documents table with every awkward row, and helpers of the tests here."""

import os

LONG = ("lorem ipsum dolor sit amet consetetur " * 3000).strip()
PASSAGE = "the quick brown fox jumps over the lazy dog and runs far away from here today"
ROWS = [
    (0, f"An Ordinary text. {PASSAGE} and more of it", "en", "a"),
    (1, None, "en", "a"),
    (2, "", None, "b"),
    (3, "   \n\t ", "de", None),
    (4, LONG, "en", "a"),
    (5, f"An Ordinary text. {PASSAGE} and more of it", "en", "a"),
    (5, f"An Ordinary text. {PASSAGE} and more of it", "en", "a"),
    (None, "no id here, token=abcdefghijklmnop", None, None),
    (6, "x" * 5000, "fr", "a"),
    (7, "Ünïcödé 𝄞 text ße a b \x1cc \x85d İ Σ日本語", "de", "b"),
    (8, "three words only", "en", "b"),
    (9, "three words only", "en", "b"),
    (10, "1234 5678 !!!", "en", "b"),
    (11, "line one\nline one\nline one\n\n\nline two", "en", "b"),
    (12, "#### **** $$$$ |||| <<<<", "en", "b"),
    (13, "a b c a b c a b c", "es", "a"),
]
SCHEMA = ("doc_id long, text string, lang string, source string, n_tokens string, kept int, start string, cls string, "
          "key string, blob int, n_words string, bin int, grp string, score string")
#: Names that the stages and operators give columns of their own, and some that look internal.
CLASHES = ["__text", "__findings", "__encode", "__lang", "__id", "__hash", "__blob", "__decontam_key", "lang_pred", "text_hash",
           "id_text", "findings", "text_key", "own", "tongue"]
SCHEMA += "".join(f", `{c}` string" for c in CLASHES)


def documents(spark, rows=ROWS):
    """The rows with extra columns whose names clash with those the operators use."""
    return spark.createDataFrame([(*r, "x", None, "x", "x", "x", 1, "x", 2, "x", "x", *CLASHES) for r in rows], SCHEMA)


def folder(spark, tmp_path, rows=ROWS, benchmark=None, pages=None):
    """A data folder of these tables."""
    d = str(tmp_path)
    documents(spark, rows).coalesce(1).write.parquet(os.path.join(d, "documents.parquet"))
    spark.createDataFrame(benchmark or [], "item_id long, text string, doc_id string").coalesce(1).write.parquet(
        os.path.join(d, "benchmark.parquet"))
    spark.createDataFrame(pages or [], "page_id long, url string, html string, blob string").coalesce(1).write.parquet(
        os.path.join(d, "pages.parquet"))
    return d


def text_of(t):
    return t or ""
