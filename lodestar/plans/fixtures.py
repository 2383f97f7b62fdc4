"""Derived inputs built from the driver's tables (see FIXTURES.md, X1-X9).

Every fixture is a Spark plan over the given parquet tables, so its size
grows with them; ``plans/oracle.py`` spells each one in DuckDB SQL.
Residues and constants here are fixed values of the fixtures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions.text import split_words
from lodestar.functions.text import rank_weight
from lodestar.operators.order import running_agg, with_positions

# Fixture residues and sizes.
X1_NULL_RANK, X1_RANK_ZERO, X1_RANK_NEG, X1_RANK_FLOAT, X1_RANK_TEXT = 3, 5, 7, 11, 13
X1_RANK_MOD = 17
X1_EMPTY_DOC_MOD, X1_EMPTY_DOC_RES = 19, 4
X1_EMPTY_QUERY_MOD, X1_EMPTY_QUERY_RES = 23, 6
X5_BATCH = 32
X1J_CHUNKS = 32  # files of the ordered X1j
X1_TURNS = 1_000_000  # pair_id = conv_id * X1_TURNS + turn
X8_EDGE_LINES = ["", "   ", "a", "\U0001F600x", "\u00a0pad\u00a0"]
VERSIONS = ("v6", "v7", "v8")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turn t joined with assistant turn t+1 of the same conversation.

    The join key is (conv_id, turn), so one very long conversation is spread
    over many tasks instead of landing in one.
    """
    conv = table(spark, sf_dir, "conversations")
    u = conv.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("query"))
    a = conv.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("document"))
    p = u.join(a, ["conv_id", "turn"])
    pid = F.col("conv_id").cast("bigint") * X1_TURNS + F.col("turn")
    r = F.pmod(pid, F.lit(X1_RANK_MOD))
    rank = (F.when(r == X1_NULL_RANK, F.lit(None).cast("string"))
            .when(r == X1_RANK_ZERO, F.lit("0"))
            .when(r == X1_RANK_NEG, F.lit("-1"))
            .when(r == X1_RANK_FLOAT, F.lit("2.9"))
            .when(r == X1_RANK_TEXT, F.lit("x"))
            .otherwise((F.lit(1) + F.pmod(pid, F.lit(5))).cast("string")))
    return p.select(
        pid.alias("pair_id"),
        F.when(F.pmod(pid, F.lit(X1_EMPTY_QUERY_MOD)) == X1_EMPTY_QUERY_RES, F.lit("")).otherwise(F.col("query")).alias("query"),
        F.when(F.pmod(pid, F.lit(X1_EMPTY_DOC_MOD)) == X1_EMPTY_DOC_RES, F.lit("")).otherwise(F.col("document")).alias("document"),
        rank.alias("rank"),
    )


# Hostile JSONL lines appended to X1j, with the reason each is rejected.
X1J_EXTRA_LINES = [
    ("", None),
    ("   ", None),
    ("not json", "invalid_json"),
    ("{'query': 'q0', 'document': 'd0'}", "invalid_json"),
    ('{"query": "q1", "document": "d1",}', "invalid_json"),
    ('{"query": "q2", "document": "d2"} extra', "invalid_json"),
    ('[{"query": "q3", "document": "d3"}]', "invalid_json"),
    ('{"query": "q4", "document": "d4", "rank": null}', "ok"),
    ('{"query": "q5", "document": ""}', "missing_document"),
    ('  {"query": "q6", "document": "d6", "rank": 2}  ', "ok"),
    ('{"document": "d7"}', "missing_query"),
]


def pairs_jsonl_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1j: (part, at, value), one JSON object per line from X1 (rank as a JSON number when numeric,
    absent when null) in order of pair_id, then the hostile lines above."""
    x1 = raw_pairs(spark, sf_dir)
    base = F.to_json(F.struct("query", "document"))
    numeric = F.col("rank").rlike(r"^-?[0-9]+(\.[0-9]+)?$")
    rank_json = F.when(numeric, F.col("rank")).otherwise(F.concat(F.lit('"'), F.col("rank"), F.lit('"')))
    line = F.when(F.col("rank").isNull(), base).otherwise(
        F.concat(F.expr("substring(to_json(struct(query, document)), 1, length(to_json(struct(query, document))) - 1)"),
                 F.lit(',"rank":'), rank_json, F.lit("}")))
    lines = x1.select(F.lit(0).alias("part"), F.col("pair_id").alias("at"), line.alias("value"))
    extra = spark.createDataFrame([(1, i, v) for i, (v, _) in enumerate(X1J_EXTRA_LINES)], "part int, at long, value string")
    return lines.unionByName(extra)


def pairs_jsonl_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of X1j in any order."""
    return pairs_jsonl_in_order(spark, sf_dir).select("value")


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index hits (doc_id, query, title, snippet, rank) from documents."""
    d = table(spark, sf_dir, "documents")
    nl = F.instr("text", "\n")
    title = F.substring_index("text", "\n", 1)
    snippet = F.when(nl > 0, F.expr("substring(text, instr(text, '\n') + 1)"))
    r = F.pmod("doc_id", F.lit(5))
    return d.select(
        "doc_id",
        F.array_join(F.slice(split_words("text"), 1, 3), " ").alias("query"),
        F.when(r == 0, F.lit(None).cast("string")).when(r == 1, F.lit("")).otherwise(title).alias("title"),
        F.when(r == 2, F.lit(None).cast("string")).when(r == 3, F.lit("")).otherwise(snippet).alias("snippet"),
        (F.lit(1) + F.pmod("doc_id", F.lit(4))).cast("string").alias("rank"),
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents split on newline, version by doc_id % 3, plus edge rows.

    ``pos`` is the line position inside its version (order: doc_id, line_no).
    """
    docs = _line_docs(spark, sf_dir)
    x = _placed(docs, _line_counts(docs))
    # Spread lines by their own key (a single huge document must not stay in
    # one partition), then land them once: most consumers read them repeatedly.
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return x.repartition(n, "version", "pos").checkpoint(eager=True)


def _line_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(version, doc_id, text) of all X3 lines."""
    d = table(spark, sf_dir, "documents")
    version = F.concat(F.lit("v"), (F.lit(6) + F.pmod("doc_id", F.lit(3))).cast("string"))
    docs = d.select(version.alias("version"), "doc_id", "text")
    # The edge rows form one extra document (none of them holds a newline).
    edge = spark.createDataFrame([("v6", -1, "\n".join(X8_EDGE_LINES))], "version string, doc_id long, text string")
    return docs.unionByName(edge)


def _line_counts(docs: DataFrame) -> DataFrame:
    """(version, doc_id, n_lines, n_chars, _off) per document."""
    # Line offset of each document = lines of the earlier documents of its version:
    # a running sum over the narrow (version, doc_id, n_lines) table, joined back.
    counts = docs.select("version", "doc_id", F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines"),
                         F.length("text").cast("long").alias("n_chars"))
    offs = running_agg(counts, ["doc_id"], "n_lines", group_by=["version"], how="sum", inclusive=False, out="_off")
    return offs.withColumn("_off", F.coalesce("_off", F.lit(0)))


def _placed(docs: DataFrame, counts: DataFrame) -> DataFrame:
    offs = counts.select("version", "doc_id", "_off")
    x = docs.join(offs, ["version", "doc_id"]).select(
        "version", "doc_id", "_off", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    return x.select("version", "doc_id", F.col("line_no").cast("long").alias("line_no"), "line",
                    (F.col("_off") + F.col("line_no")).cast("long").alias("pos"))


def line_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the X3 lines of each document begin, a narrow row per document, landed: readers that take
    the lines in parts, or their keys alone, agree on the positions."""
    return _line_counts(_line_docs(spark, sf_dir)).checkpoint(eager=True)


def line_part(spark: SparkSession, sf_dir: str, places: DataFrame, part: int, parts: int) -> DataFrame:
    """The X3 lines of one of ``parts`` shares of the documents, not landed."""
    mine = F.pmod(F.xxhash64("doc_id"), F.lit(parts)) == part
    return _placed(_line_docs(spark, sf_dir).filter(mine), places)


def line_keys(places: DataFrame) -> DataFrame:
    """(version, pos) of all X3 lines, from the narrow table alone."""
    n = F.col("n_lines")
    x = places.select("version", "doc_id", "n_lines").join(places.select("version", "doc_id", "_off"), ["version", "doc_id"])
    return x.select("version", "_off", F.explode(F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1))).alias("_i")).select(
        "version", (F.col("_off") + F.col("_i")).alias("pos"))


def line_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts whose words are those of the X3 lines (a line feed separates words like any space),
    without line positions: all that a vocabulary or a word count needs."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("line"))
    version = F.concat(F.lit("v"), (F.lit(6) + F.pmod("doc_id", F.lit(3))).cast("string"))
    edge = spark.createDataFrame([("v6", "\n".join(X8_EDGE_LINES))], "version string, line string")
    return d.select(version.alias("version"), "line").unionByName(edge)


def vector_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even vec_id = query, odd = document; pos = vec_id div 2; batches of 32."""
    e = table(spark, sf_dir, "embeddings")
    q = e.filter(F.pmod("vec_id", F.lit(2)) == 0).select(
        F.expr("vec_id div 2").alias("pos"), F.col("embedding").alias("qv"))
    dd = e.filter(F.pmod("vec_id", F.lit(2)) == 1).select(
        F.expr("vec_id div 2").alias("pos"), F.col("embedding").alias("dv"))
    x = q.join(dd, "pos")
    rank = F.lit(1) + F.pmod("pos", F.lit(5))
    return x.select("pos", F.expr(f"pos div {X5_BATCH}").alias("batch_id"), "qv", "dv",
                    rank.cast("int").alias("rank"), rank_weight(rank).alias("weight"))


def vector_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X5 and two more batches: -1 has one pair, -2 six pairs of the first positions where each two share
    their document (tied scores); positions go on downwards, rank 1."""
    x = vector_pairs(spark, sf_dir)
    one = x.filter("pos = 0").withColumn("batch_id", F.lit(-1).cast("bigint"))
    twos = x.filter("pos < 6").drop("dv").join(
        x.filter("pos < 6 and pos % 2 = 0").select(F.col("pos").alias("_even"), "dv"),
        F.col("pos") - F.pmod("pos", F.lit(2)) == F.col("_even")).drop("_even").withColumn("batch_id", F.lit(-2).cast("bigint"))
    edges = one.unionByName(twos).withColumn("pos", F.col("batch_id") * X5_BATCH + F.col("pos")).withColumn(
        "rank", F.lit(1)).withColumn("weight", rank_weight(F.lit(1)))
    return x.unionByName(edges)


def retrieval_sets(spark: SparkSession, sf_dir: str):
    """(queries, corpus), both with their class.  task = 't' + vec_id % 3; every tenth vector
    is a query; a document is relevant (rel 1) when it has the query's label."""
    e = table(spark, sf_dir, "embeddings")
    base = e.select("vec_id", F.concat(F.lit("t"), F.pmod("vec_id", F.lit(3)).cast("string")).alias("task"),
                    "embedding", F.col("label").alias("class"))
    is_q = F.pmod("vec_id", F.lit(10)) == 0
    queries = base.filter(is_q).select("task", F.col("vec_id").alias("qid"), F.col("embedding").alias("qv"), "class")
    corpus = base.filter(~is_q).select("task", F.col("vec_id").alias("did"), F.col("embedding").alias("dv"), "class")
    return queries, corpus


def hidden_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings in groups of 5 tokens; id = vec_id div 5, tok_pos = vec_id % 5.
    mask is 0 when vec_id % 7 = 3, and 0 for every token of group 7."""
    e = table(spark, sf_dir, "embeddings")
    gid = F.expr("vec_id div 5")
    mask = F.when((F.pmod("vec_id", F.lit(7)) == 3) | (gid == 7), 0).otherwise(1)
    return e.select(gid.alias("id"), F.pmod("vec_id", F.lit(5)).cast("int").alias("tok_pos"),
                    F.col("embedding").cast("array<double>").alias("hidden"), mask.alias("mask"),
                    F.pmod(gid, F.lit(5)).cast("int").alias("eos_pos"))


def metric_log(spark: SparkSession, sf_dir: str, timed: bool = False) -> DataFrame:
    """(run, step, loss, tokens, dt, task, score) from events; ``timed`` adds their time as ``ts``.

    run = user_id % 4; step = 1 + rank of event_id within the run (range-
    partitioned positions, no per-run window).
    """
    ev = table(spark, sf_dir, "events")
    x = ev.select(F.pmod("user_id", F.lit(4)).alias("run"), "event_id", "event_type", "value", "props", "ts")
    x = with_positions(x, ["event_id"], pos="_p", group_by=["run"])
    dt = F.when(F.pmod("event_id", F.lit(13)) == 0, F.lit(0.0)).otherwise(
        F.lit(0.25) * (F.lit(1) + F.pmod("event_id", F.lit(4))).cast("double"))
    return x.select(
        "run", (F.col("_p") + 1).alias("step"), F.col("value").alias("loss"),
        F.get_json_object("props", "$.k").cast("long").alias("tokens"), dt.alias("dt"),
        F.col("event_type").alias("task"), (F.col("value") / 500.0).alias("score"), *(["ts"] if timed else []))
