"""Vocabulary build, tokenization by vocabulary join, batch padding and packing.

Tokenization never moves a row per word occurrence.  Texts are cut into words in the
JVM, and Arrow dictionary-encodes the words of a chunk of texts where they lie: codes per text,
and the chunk's distinct words once.  Only the distinct words meet the vocabulary, in a left
join (broadcast below the session threshold, otherwise a shuffle join with the most
frequent words broadcast), and come back to their chunk, where the codes are mapped
in place by one ``take``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from lodestar.functions import arrays as AR
from lodestar.functions.text import split_words
from lodestar.operators.order import with_positions
from lodestar.session import broadcast_row_limit, scratch_path, ship_package

# Reserved vocabulary entries (token text, id).
RESERVED = [("<pad>", 0), ("<eos>", 1), ("<bos>", 2), ("<unk>", 3),
            ("<mask>", 4), ("<sep>", 5), ("<unused0>", 6), ("<unused1>", 7)]
#: Most frequent words that are broadcast when the vocabulary is not.
HOT_WORDS = 4096
#: Words of a chunk of texts that are dictionary-encoded together (a longer text is a chunk of its own).
CHUNK_WORDS = 1 << 19
SPECIAL_PATTERN = "(" + "|".join(t for t, _ in RESERVED) + ")"


def build_vocab(df: DataFrame, text: str, max_size: int | None = None, reserved=RESERVED) -> DataFrame:
    """(token, id, n): words by count desc then token asc, ids after the reserved ones.

    With ``max_size`` the top words are a bounded top-k (partial top-k per
    partition, then a merge); without it ids come from range-partitioned
    positions over the distinct words.
    """
    spark = df.sparkSession
    res_tokens = [F.lit(t) for t, _ in reserved]
    counts = (df.select(F.explode(split_words(text)).alias("token"))
              .groupBy("token").agg(F.count(F.lit(1)).alias("n"))
              .filter(~F.col("token").isin(*res_tokens)))
    base = len(reserved)
    if max_size is not None:
        top = counts.orderBy(F.col("n").desc(), F.col("token").asc()).limit(max_size)
        w = Window.orderBy(F.col("n").desc(), F.col("token").asc())  # at most max_size rows
        words = top.withColumn("id", (F.row_number().over(w) - 1 + base).cast("int"))
    else:
        words = with_positions(counts, [F.col("n").desc(), F.col("token").asc()], pos="_p")
        words = words.withColumn("id", (F.col("_p") + base).cast("int")).drop("_p")
    res = spark.createDataFrame([(t, i, 0) for t, i in reserved], "token string, id int, n long")
    # Small and read by every tokenization that follows: land it once.
    return words.select("token", "id", "n").unionByName(res).checkpoint(eager=True)


def spaced_words(text: str):
    """Words of a text, special markers being words of their own."""
    spaced = F.when(F.instr(F.col(text), "<") > 0,
                    F.regexp_replace(F.col(text), SPECIAL_PATTERN, " $1 ")).otherwise(F.col(text))
    return split_words(spaced)


def _look_up(words: DataFrame, vocab: DataFrame, spread) -> DataFrame:
    """``words`` with ``_tid``, the id of ``token``, null where the vocabulary lacks it.

    Too large to broadcast, a vocabulary sends its HOT_WORDS most frequent words (lowest ids), the
    others are joined on the word.  Rows that need no join partner get a ``spread`` key of their own,
    so neither a frequent word nor a null one meets in one partition.
    """
    v = vocab.select("token", F.col("id").alias("_tid"))
    if vocab.count() <= broadcast_row_limit(words.sparkSession, 96):
        return words.join(F.broadcast(v), "token", "left")
    hot = v.filter(F.col("_tid") < len(RESERVED) + HOT_WORDS)
    rest = v.filter(F.col("_tid") >= len(RESERVED) + HOT_WORDS).select(
        F.col("token").alias("_key"), F.col("_tid").alias("_rest"))
    done = F.col("_tid").isNotNull() | F.col("token").isNull()
    return (words.join(F.broadcast(hot), "token", "left")
            .withColumn("_key", F.when(done, F.concat(F.lit("\u0000"), spread)).otherwise(F.col("token")))
            .join(rest, "_key", "left").withColumn("_tid", F.coalesce("_tid", "_rest")).drop("_key", "_rest"))


def tokenize(df: DataFrame, keys, text: str, vocab: DataFrame, unk: int = AR.UNK_ID,
             add_bos: bool = True, out: str = "tokens", keep_input: bool = True,
             long_form: bool = False, codes: str | None = None) -> DataFrame:
    """Add ``out`` = [BOS] + vocabulary ids of the words of ``text`` (UNK for misses).

    With ``keep_input=False`` the result is just (keys, out) and no join back to the input is needed.
    ``long_form=True`` returns (keys, tok_pos, token_id) rows — BOS at 0 — from a join per word, so
    a single huge text is never gathered into one task.  A null text has no words.  ``codes`` names the
    folder for the landed word codes, for a caller that drops it when the result has been written.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if long_form:
        ex = df.select(*keys, F.posexplode_outer(spaced_words(text)).alias("_i", "token"))
        j = _look_up(ex, vocab, F.xxhash64(*[F.col(k) for k in keys], "_i").cast("string"))
        shift = 1 if add_bos else 0
        words = j.filter(F.col("_i").isNotNull()).select(
            *keys, (F.col("_i") + shift).alias("tok_pos"), F.coalesce("_tid", F.lit(unk)).alias("token_id"))
        if not add_bos:
            return words
        bos = df.select(*keys, F.lit(0).alias("tok_pos"), F.lit(AR.BOS_ID).alias("token_id"))
        return words.unionByName(bos)
    ship_package(df.sparkSession)
    chunks = _chunks(df, keys, text, codes) if codes else _chunks(df, keys, text)
    texts, words = chunks.filter(F.col("_word").isNull()), chunks.filter(F.col("_word").isNotNull())
    found = _look_up(words.select("_chunk", F.col("_at").alias("_c"), F.col("_word").alias("token")), vocab,
                     F.xxhash64("_chunk", "_c").cast("string")).select(
        "_chunk", "_c", F.coalesce("_tid", F.lit(unk)).cast("int").alias("_tid"))
    # both sides come from one table: new names' identities keep them apart in the cogroup
    texts, found = (t.select(*[F.col(c).alias(c) for c in t.columns]) for t in (texts.select("_chunk", *keys, "_codes"), found))
    schema = StructType([texts.schema[k] for k in keys] + [StructField(out, ArrayType(IntegerType()))])
    res = texts.groupBy("_chunk").cogroup(found.groupBy("_chunk")).applyInArrow(
        _take_ids(keys, out, AR.BOS_ID if add_bos else None, to_arrow_schema(schema)), schema)
    return df.join(res, keys) if keep_input else res


def _chunks(df: DataFrame, keys: list[str], text: str, path: str | None = None) -> DataFrame:
    """Texts as word codes, and the distinct words of each chunk of texts.

    Rows (_chunk, keys, _codes) of texts and (_chunk, _at, _word) of words, landed: a chunk's number comes
    from the task that made it.
    """
    spark = df.sparkSession
    src = df.select(*keys, F.coalesce(spaced_words(text), F.array().cast("array<string>")).alias("_words"))
    none = StructType([StructField(f.name, f.dataType, True) for f in src.select(*keys).schema])
    schema = StructType(none.fields + [StructField("_chunk", LongType()), StructField("_codes", ArrayType(IntegerType())),
                                       StructField("_at", IntegerType()), StructField("_word", StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 32
        held, size = [], 0
        for batch in batches:
            ends = pc.cumulative_sum(pc.list_value_length(batch.column("_words"))).to_numpy(zero_copy_only=False)
            a = 0
            while a < batch.num_rows:
                before = int(ends[a - 1]) if a else 0
                b = max(a + 1, int(np.searchsorted(ends, before + CHUNK_WORDS - size, "right")))
                held.append(batch.slice(a, b - a))
                size += int(ends[b - 1]) - before
                a = b
                if size >= CHUNK_WORDS:
                    yield from encoded(held, chunk)
                    held, size, chunk = [], 0, chunk + 1
        if held:
            yield from encoded(held, chunk)

    def encoded(held, chunk):
        table = pa.Table.from_batches(held).combine_chunks()
        words = table.column("_words").chunk(0) if table.num_rows else pa.array([], pa.list_(pa.string()))
        enc = words.flatten().dictionary_encode()
        n, m = table.num_rows, len(enc.dictionary)
        codes = pa.ListArray.from_arrays(_offsets(words), enc.indices.cast(pa.int32()))
        cols = {k: table.column(k).combine_chunks() for k in keys}
        cols |= {"_chunk": pa.array(np.full(n, chunk)), "_codes": codes}
        yield from pa.table([_as(cols.get(f.name), f.type, n) for f in arrow], schema=arrow).to_batches()
        cols = {"_chunk": pa.array(np.full(m, chunk)), "_at": pa.array(np.arange(m, dtype=np.int32)), "_word": enc.dictionary}
        yield from pa.table([_as(cols.get(f.name), f.type, m) for f in arrow], schema=arrow).to_batches()

    path = path or scratch_path(spark, "token-codes")
    src.mapInArrow(run, schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def _as(column, kind, n: int) -> pa.Array:
    if column is None:
        return pa.nulls(n, kind)
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column if column.type == kind else column.cast(kind)


def _offsets(lists: pa.Array) -> pa.Array:
    """Offsets of the lists into their flattened values (a slice's own begin elsewhere)."""
    return pa.array(np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int32))


def _take_ids(keys, out, bos, arrow):
    def run(texts: pa.Table, words: pa.Table) -> pa.Table:
        ids = np.zeros(words.num_rows, np.int32)
        ids[words.column("_c").to_numpy()] = words.column("_tid").to_numpy()
        codes = texts.column("_codes").combine_chunks()
        if isinstance(codes, pa.ChunkedArray):  # no text
            codes = pa.array([], pa.list_(pa.int32()))
        offsets = _offsets(codes).to_numpy()
        flat = ids[codes.flatten().to_numpy(zero_copy_only=False)] if len(ids) else ids
        if bos is not None:
            flat = np.insert(flat, offsets[:-1], bos)
            offsets = offsets + np.arange(len(offsets), dtype=np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
        return pa.table([*(texts.column(k) for k in keys), lists], names=[*keys, out]).cast(arrow)
    return run


def batch_max_length(df: DataFrame, batch_id: str, tokens: str, cap: int, by=()) -> DataFrame:
    """Batch maximum token length, capped at ``cap``: (batch_id, by..., max_len)."""
    return (df.groupBy(batch_id, *by)
            .agg(F.least(F.max(F.size(tokens)), F.lit(cap)).cast("int").alias("max_len")))


def pad_to_batch(df: DataFrame, tokens: str, batch_id: str, max_length: int, by=(), pad: int = AR.PAD_ID,
                 out: str = "input_ids") -> DataFrame:
    """Truncate to ``max_length`` then right-pad to the batch maximum (window over
    a bounded batch).  Adds ``out`` and ``batch_len``."""
    w = Window.partitionBy(batch_id, *by)
    t = df.withColumn("_tr", AR.truncate(tokens, max_length))
    t = t.withColumn("batch_len", F.max(F.size("_tr")).over(w))
    return t.withColumn(out, AR.pad_to("_tr", F.col("batch_len"), pad)).drop("_tr")


def pack_token_budget(df: DataFrame, pos: str, length: str, budget: int, buffer: int = 1000,
                      seed: int = 42) -> DataFrame:
    """Token-budget batching: within each buffer of ``buffer`` consecutive
    positions, sort by (length, pos) and greedily close a batch before
    ``count * max_len`` would exceed ``budget``; a single over-budget sample is
    its own batch.  Adds (buffer_id, batch_id, batch_key); batch_id order is md5-shuffled.

    The lengths of a buffer, at most ``buffer`` of them, are one sorted array, and the packing is a fold over it
    with the present batch's number, count and longest length.  Rows come sorted, so a batch is a run: the
    fold keeps where each begins.
    """
    t = df.withColumn("buffer_id", F.expr(f"`{pos}` div {buffer}"))
    one = F.struct(F.col(length).cast("bigint").alias("len"), F.col(pos).cast("bigint").alias("pos"))
    sorted_ = t.groupBy("buffer_id").agg(F.array_sort(F.collect_list(one)).alias("_s"))
    begin = F.struct(F.lit(0).cast("bigint").alias("count"), F.lit(0).cast("int").alias("at"),
                     F.array().cast("array<int>").alias("starts"))

    def step(acc, x):
        # sorted by length: the row is the longest so far
        opens = (acc["count"] == 0) | ((acc["count"] + 1) * x["len"] > budget)
        return F.struct(F.when(opens, F.lit(1).cast("bigint")).otherwise(acc["count"] + 1).alias("count"),
                        (acc["at"] + 1).alias("at"),
                        F.when(opens, F.concat(acc["starts"], F.array(acc["at"]))).otherwise(acc["starts"]).alias("starts"))

    runs = sorted_.select("buffer_id", "_s", F.aggregate("_s", begin, step, lambda acc: acc["starts"]).alias("_b"))
    batches = runs.select("buffer_id", "_s", F.posexplode(F.transform("_b", lambda s, k: F.struct(
        s.alias("a"), F.coalesce(F.get("_b", k + 1), F.size("_s")).alias("b")))).alias("_local", "_run"))
    packed = batches.select("buffer_id", "_local", F.explode(F.slice(
        "_s", F.col("_run.a") + 1, F.col("_run.b") - F.col("_run.a"))["pos"]).alias(pos))
    out = t.join(packed, ["buffer_id", pos])
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit("pack"), F.col("buffer_id").cast("string"),
                            F.col("_local").cast("string")))
    return out.withColumn("batch_key", key).withColumn(
        "batch_id", F.concat_ws("-", F.col("buffer_id").cast("string"), F.col("_local").cast("string"))).drop("_local")
