"""Secret scan with an incremental blob ledger (operator 7); DataFrame functions only.

Every version of every path is content-addressed: its blob is the SHA-256 of
its text.  The ledger is a table with one row per scanned (blob, rule version)
and that blob's findings, empty ones included.  ``scan`` cuts the given
versions down to one copy per blob (combined on the map side, so a text that a
third of the rows share is one row per task), drops the blobs that the ledger
holds for the present rules, scans the rest and appends them.
``findings_by_path`` joins the ledger back to all versions.  A changed rule set
has another version, so all blobs are scanned for it once.

Positions are code points, the end exclusive.  Per rule, matches are leftmost
and do not overlap; a match whose value is too short is dropped, not retried.

Defined cases: a null text is the empty text; copies and repeated rows share
one ledger row and each get all findings; an empty table adds nothing to the
ledger; columns other than the text take no part.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.llm.common import fresh


@dataclass(frozen=True)
class Rule:
    """``group`` is the part whose length must reach ``min_chars`` (0: the whole match)."""

    kind: str
    pattern: str
    group: int = 0
    min_chars: int = 1


# The three base rules.  A maximal run of one class of characters is its only
# possible match, so for access and hex a length bound in the pattern drops the same matches.
BASE_RULES = (
    Rule("assign", "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
         2, 12),
    Rule("access", "AKIA[A-Z0-9]{14,}"),
    Rule("hex", "[0-9a-f]{16,}"),
)
#: Further rules of this library, listed after the base ones.
MORE_RULES = (
    Rule("pem", "-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
)
RULES = BASE_RULES + MORE_RULES

_FINDINGS = "array<struct<start:int,no:int,end:int,kind:string>>"
LEDGER_SCHEMA = f"blob string, rules string, findings {_FINDINGS}"


def rules_version(rules=RULES) -> str:
    return hashlib.sha256(repr(tuple(rules)).encode()).hexdigest()[:16]


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)


def _matches(text: Column, no: int, r: Rule) -> Column:
    """(no, i, lead, len, ok) of each match: characters before it since the last one, and its length."""
    pat = F.lit(r.pattern)
    zipped = F.arrays_zip(F.split(text, r.pattern, -1).alias("lead"),
                          F.regexp_extract_all(text, pat, F.lit(0)).alias("all"),
                          F.regexp_extract_all(text, pat, F.lit(r.group)).alias("val"))
    arr = F.transform(zipped, lambda x, i: F.struct(
        F.lit(no).alias("no"), i.alias("i"), F.char_length(x["lead"]).alias("lead"),
        F.char_length(x["all"]).alias("len"), (F.char_length(x["val"]) >= r.min_chars).alias("ok")))
    # most texts have no match: one pass over the text decides
    return F.when(F.regexp_like(text, pat), arr)


def find(blobs: DataFrame, rules=RULES) -> DataFrame:
    """(blob, findings) for a table (blob, text) with one row per blob.

    Spark has no positions of all matches; they are running sums over the
    lengths of the pieces between matches and of the matches.
    """
    none = F.array().cast("array<struct<no:int,i:int,lead:int,len:int,ok:boolean>>")
    m = blobs.select("blob", F.explode_outer(F.concat(
        *[F.coalesce(_matches(F.col("text"), k, r), none) for k, r in enumerate(rules)])).alias("m"))
    before = Window.partitionBy("blob", "m.no").orderBy("m.i")
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    ends = m.withColumn("end", F.sum(F.col("m.lead") + F.coalesce("m.len", F.lit(0))).over(before).cast("int"))
    hit = F.when(F.col("m.ok"), F.struct(
        (F.col("end") - F.col("m.len")).alias("start"), F.col("m.no").alias("no"), F.col("end").alias("end"),
        F.get(kinds, F.col("m.no")).alias("kind")))
    return ends.groupBy("blob").agg(F.array_sort(F.collect_list(hit)).cast(_FINDINGS).alias("findings"))


def _ledger(spark: SparkSession, path: str, version: str) -> DataFrame | None:
    """Ledger rows of a rule version; None where no ledger has been begun."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return None
    return spark.read.schema(LEDGER_SCHEMA).parquet(path).filter(F.col("rules") == version)


def scan(versions: DataFrame, ledger_path: str, text_col: str = "text", rules=RULES) -> None:
    """Scan the blobs of ``versions`` that the ledger lacks for these rules, and append them."""
    spark = versions.sparkSession
    version = rules_version(rules)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    blobs = (versions.select(text.alias("text")).withColumn("blob", F.sha2("text", 256))
             .groupBy("blob").agg(F.first("text").alias("text")))
    seen = _ledger(spark, ledger_path, version)
    if seen is not None:
        blobs = blobs.join(seen.select("blob").distinct(), "blob", "left_anti")
    (find(blobs, rules).select("blob", F.lit(version).alias("rules"), "findings")
     .write.mode("append").parquet(ledger_path))


def findings_by_path(versions: DataFrame, ledger_path: str, text_col: str = "text", rules=RULES,
                     out: str = "findings") -> DataFrame:
    """``versions`` with its findings (sorted by start, then rule) from the ledger."""
    spark = versions.sparkSession
    seen = _ledger(spark, ledger_path, rules_version(rules))
    # two runs that scanned at the same time may both have appended a blob
    led = seen.groupBy("blob").agg(F.first("findings").alias(out))
    cols = [c for c in versions.columns if c != out]
    own, got = fresh([*cols, out], "blob", "findings")
    return (versions.select(*[F.col(f"`{c}`") for c in cols], blob_of(F.col(text_col)).alias(own))
            .join(led.select(F.col("blob").alias(own), F.col(out).alias(got)), own, "left")
            .select(*[F.col(f"`{c}`") for c in cols], F.col(got).alias(out)))


def spans_text(findings: Column, kinds=None) -> Column:
    """kind:start:end of the findings (of some kinds), comma-joined."""
    if kinds is not None:
        findings = F.filter(findings, lambda f: f["kind"].isin(list(kinds)))
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(
        ":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")


def redact(text: Column, findings: Column, mark: str = "[SECRET]") -> Column:
    """The text with every found span, overlapping ones as one, replaced by ``mark``."""
    empty = F.array().cast("array<struct<s:int,e:int>>")
    merged = F.aggregate(
        findings, empty,
        lambda acc, f: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["e"] >= f["start"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                F.element_at(acc, -1)["s"].alias("s"),
                F.greatest(F.element_at(acc, -1)["e"], f["end"]).alias("e")))))
        .otherwise(F.concat(acc, F.array(F.struct(f["start"].alias("s"), f["end"].alias("e"))))))
    edges = F.concat(merged, F.array(F.struct(F.char_length(text).alias("s"), F.char_length(text).alias("e"))))
    pieces = F.transform(edges, lambda x, i: F.struct(
        F.when(i > 0, F.get(edges, i - 1)["e"]).otherwise(F.lit(0)).alias("a"), x["s"].alias("b")))
    cut = F.array_join(F.transform(pieces, lambda p: F.substr(text, p["a"] + 1, p["b"] - p["a"])), mark)
    return F.when(F.size(findings) > 0, cut).otherwise(text)


def redact_documents(docs: DataFrame, ledger_path: str, text_col: str = "text", rules=RULES,
                     mark: str = "[SECRET]") -> DataFrame:
    """``docs`` scanned through the ledger, with the found spans replaced; all rows and columns stay."""
    scan(docs, ledger_path, text_col, rules)
    own = fresh(docs.columns, "findings")[0]
    found = findings_by_path(docs, ledger_path, text_col, rules, out=own)
    text = F.col(text_col)
    return found.withColumn(text_col, F.when(text.isNotNull(), redact(text, F.col(own), mark))).drop(own)
