"""Structured Streaming forms of the pair, batch, embedding, best-score and
metric-window operators.  Each runs with ``trigger(availableNow=True)`` over a
file source, with its checkpoint in the shared folder, so a restart resumes
where it stopped.  Jobs that write in ``foreachBatch`` give every epoch a folder of its own in
overwrite mode, so a micro-batch that is replayed after a failure replaces what it had written.
"""

from __future__ import annotations

import re
import time

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from lodestar.functions import text as T
from lodestar.operators.encode import DrawEncoder, encode_texts
from lodestar.operators.order import batch_fixed, with_positions
from lodestar.session import ship_package
from lodestar.sources.jsonl import pairs_from_lines, read_pairs_jsonl


def _run(writer, timeout_s: int | None = None, spark: SparkSession | None = None,
         state_partitions: int | None = None):
    """Start with availableNow and wait.  ``state_partitions`` fixes the number
    of state-store partitions of a stateful query (taken from
    spark.sql.shuffle.partitions when the query first starts and then kept in
    its checkpoint); the session value is restored right after the start."""
    old = None
    if spark is not None and state_partitions:
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        q = writer.trigger(availableNow=True).start()
    finally:
        if old is not None:
            spark.conf.set("spark.sql.shuffle.partitions", old)
    q.awaitTermination(timeout_s)
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


def stream_pairs(spark: SparkSession, in_path: str, out_path: str, checkpoint: str) -> None:
    """JSONL pairs -> cleaned, prompted, weighted rows appended as Parquet."""
    p = read_pairs_jsonl(spark, in_path, stream=True)
    out = p.select(T.prompt("query", F.lit("query")).alias("query_text"),
                   T.prompt("positive", F.lit("document")).alias("doc_text"),
                   "rank", T.rank_weight("rank").alias("weight"))
    _run(out.writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).outputMode("append"))


def _committed_before(spark: SparkSession, folder: str, epoch_id: int | None = None) -> str | None:
    """The newest committed epoch folder, or the newest one before an epoch."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/epoch-*/next/_SUCCESS")
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p) or []
    paths = [f.getPath().getParent().getParent().toString() for f in found]
    return max((x for x in paths if epoch_id is None or int(x.rsplit("-", 1)[1]) < epoch_id), default=None)


_BATCHED = "query string, positive string, rank int, pos bigint, batch_id bigint, slot bigint"


def stream_batches(spark: SparkSession, in_path: str, out_path: str, checkpoint: str, size: int = 16,
                   max_files_per_trigger: int = 4) -> None:
    """Fixed-size batches that go on across triggers: batch_id = pos div size over all rows so far.

    Rows come in order of arrival: by trigger, then by file name and line.  A trigger emits the batches that its
    rows complete.  The rows of the batch still open, fewer than ``size``, and the next position are carried
    to the next trigger in a table with a folder per epoch; an epoch is committed once its ``next`` is
    written, begins from the newest epoch committed before it, and when replayed replaces what it had
    written.  ``read_batches`` reads the result, the open batch as the last one.
    """
    p = (spark.readStream.option("lineSep", "\n").option("maxFilesPerTrigger", max_files_per_trigger).text(in_path)
         .select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")))
    pairs = pairs_from_lines(p, keep=["_file", "_block"])

    def per_batch(df: DataFrame, epoch_id: int) -> None:
        last = _committed_before(spark, out_path, epoch_id)
        start = spark.read.parquet(f"{last}/next").first()["next"] if last else 0
        # rows of a split are consecutive in their partition
        numbered = df.withColumn("_row", F.monotonically_increasing_id())
        rows = with_positions(numbered, ["_file", "_block", "_row"]).select(
            "query", "positive", F.col("rank").cast("int").alias("rank"), (F.col("pos") + start).alias("pos"))
        if last:
            rows = rows.unionByName(_carried(spark, last))
        upto = start + df.count()
        epoch = f"{out_path}/epoch-{epoch_id:012d}"
        batch_fixed(rows, "pos", size).withColumn("open", (F.col("pos") >= upto - upto % size).cast("int")).write.mode(
            "overwrite").partitionBy("open").parquet(f"{epoch}/rows")
        spark.range(1).select(F.lit(upto).cast("bigint").alias("next")).write.mode("overwrite").parquet(f"{epoch}/next")

    _run(pairs.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint))


def _carried(spark: SparkSession, epoch: str) -> DataFrame:
    """Rows of the batch that an epoch left open."""
    return (spark.read.schema(f"{_BATCHED}, open int").parquet(f"{epoch}/rows").filter(F.col("open") == 1)
            .select("query", "positive", "rank", "pos"))


def read_batches(spark: SparkSession, out_path: str) -> DataFrame:
    """(query, positive, rank, pos, batch_id, slot) of all committed epochs; rows of the open batch come last."""
    last = _committed_before(spark, out_path)
    if last is None:
        return spark.createDataFrame([], _BATCHED)
    upto = int(last.rsplit("-", 1)[1])
    said = F.col("_metadata.file_path")  # each epoch is a table of its own: its number and open are read from the path
    rows = (spark.read.schema(_BATCHED).option("recursiveFileLookup", "true").parquet(f"{out_path}/epoch-*/rows")
            .withColumn("_epoch", F.regexp_extract(said, r"epoch-(\d+)", 1).cast("bigint"))
            .withColumn("open", F.regexp_extract(said, r"open=(\d)", 1).cast("int")))
    # an open row is part of the result only in the newest epoch: later ones carry it on
    return rows.filter((F.col("_epoch") <= upto) & ((F.col("open") == 0) | (F.col("_epoch") == upto))).drop("_epoch", "open")


def touch_in_order(spark: SparkSession, path: str) -> None:
    """Give the files below a folder modification times in order of their names, a second apart: a file stream
    takes files by that time."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    it, files = fs.listFiles(p, True), []
    while it.hasNext():
        f = it.next().getPath()
        if not f.getName().startswith(("_", ".")):
            files.append(f)
    files.sort(key=lambda f: [int(x) if x.isdigit() else x for x in re.split(r"(\d+)", f.toString())])
    now = int(time.time()) * 1000
    for i, f in enumerate(files):
        fs.setTimes(f, now - 1000 * (len(files) - i), -1)


def stream_embed(spark: SparkSession, in_path: str, out_path: str, checkpoint: str, schema, keys,
                 text: str = "text", role="document", pooling: str = "mean", max_files_per_trigger: int = 4) -> None:
    """Parquet rows -> (keys, embedding) of the default encoder, a folder per epoch; rows stay in their tasks."""
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(in_path)
    role_c = F.lit(role) if role in ("query", "document") else F.col(role)

    def per_batch(df: DataFrame, epoch_id: int) -> None:
        vec = encode_texts(df, text, role_c, DrawEncoder.factory(), pooling=pooling, element="double")
        vec.select(*([keys] if isinstance(keys, str) else keys), "embedding").write.mode("overwrite").parquet(
            f"{out_path}/epoch={epoch_id}")

    _run(src.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint))


def files_per_trigger(spark: SparkSession, path: str, fmt: str = "parquet", batches: int = 4) -> int:
    """maxFilesPerTrigger that drains the files now present in about ``batches`` micro-batches."""
    n = len(spark.read.format(fmt).load(path).inputFiles())
    return max(1, -(-n // batches))


def _complete_to_parquet(agg: DataFrame, out_path: str, checkpoint: str, state_partitions: int | None) -> None:
    """Each epoch's whole result in its own folder; ``read_latest`` reads the newest complete one."""
    def write(df: DataFrame, epoch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{out_path}/epoch-{epoch_id:012d}")

    _run(agg.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint),
         spark=agg.sparkSession, state_partitions=state_partitions)


def read_latest(spark: SparkSession, out_path: str) -> DataFrame:
    """The result of the last epoch whose write was committed."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{out_path}/epoch-*/_SUCCESS")
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return spark.read.parquet(max(f.getPath().getParent().toString() for f in found))


def stream_best(spark: SparkSession, in_path: str, out_path: str, checkpoint: str, schema,
                run: str = "run", step: str = "step", score: str = "score", max_files_per_trigger: int = 4,
                state_partitions: int | None = None) -> None:
    """Best (earliest step of the highest score) per run, kept as streaming state;
    state is one row per run."""
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(in_path)
    best = src.groupBy(run).agg(F.max_by(F.struct(step, score), F.struct(F.col(score), -F.col(step))).alias("b"))
    _complete_to_parquet(best.select(run, "b.*"), out_path, checkpoint, state_partitions)


def stream_metrics(spark: SparkSession, in_path: str, out_path: str, checkpoint: str, schema,
                   width: int = 10, run: str = "run", step: str = "step", max_files_per_trigger: int = 4,
                   state_partitions: int | None = None) -> None:
    """Windows of ``width`` steps per run on a stream (complete mode: bounded runs)."""
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(in_path)
    w = F.expr(f"(`{step}` - 1) div {width}")
    agg = src.groupBy(run, w.alias("window_id")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("loss").alias("mean_loss"), F.sum("tokens").alias("tokens"))
    _complete_to_parquet(agg, out_path, checkpoint, state_partitions)


_WINDOW = ("run bigint, window_id bigint, last_step bigint, mean_loss double, instant_loss double, tokens bigint, "
           "seconds double, tokens_per_sec double")
#: Windows of a run, next to each other, that are one key of the state.
BLOCK_WINDOWS = 1024
_FIELDS = [("window_id", np.int64), ("n", np.int64), ("loss", np.float64), ("last_step", np.int64), ("instant_loss", np.float64),
           ("tokens", np.int64), ("seconds", np.float64), ("until", np.int64)]
_OPEN = ", ".join(f"{c} array<{'double' if t is np.float64 else 'bigint'}>" for c, t in _FIELDS)


def _sums(f: pd.DataFrame) -> pd.DataFrame:
    """The rows of some windows as one row per window, with the columns of the state."""
    f = f.sort_values(["window_id", "step"], kind="stable")
    g = f.groupby("window_id", sort=True)
    last = g.tail(1)
    t = g.agg(n=("step", "size"), loss=("loss", "sum"), tokens=("tokens", "sum"), seconds=("dt", "sum"), until=("until", "max"))
    return t.assign(last_step=last["step"].to_numpy(), instant_loss=last["loss"].to_numpy()).reset_index().fillna({"until": 0})


def _fold_windows(width: int):
    """Fold for (run, block of windows): the state holds the block's open windows, a list per field."""
    def fold(key, frames, state):
        mark = state.getCurrentWatermarkMs()
        names = [c for c, _ in _FIELDS]
        held = pd.DataFrame({c: np.array(v, t) for (c, t), v in zip(_FIELDS, state.get if state.exists else [[]] * len(_FIELDS))})
        if not state.hasTimedOut:
            new = pd.concat([_sums(f) for f in frames])
            new["until"] = np.maximum(new["until"], mark + 1)
            t = pd.concat([held, new[names]]).astype(dict(_FIELDS))
            last = t.sort_values(["window_id", "last_step"], kind="stable").groupby("window_id", sort=True).tail(1)
            g = t.groupby("window_id", sort=True)
            held = g.agg(n=("n", "sum"), loss=("loss", "sum"), tokens=("tokens", "sum"), seconds=("seconds", "sum"),
                         until=("until", "last")).reset_index()
            held["last_step"], held["instant_loss"] = last["last_step"].to_numpy(), last["instant_loss"].to_numpy()
        done = held[held["n"] >= width]
        held = held[(held["n"] < width) & (held["until"] >= mark)]  # the others' time has passed without all their steps
        if len(held):
            state.update(tuple(held[c].tolist() for c in names))
            state.setTimeoutTimestamp(max(int(held["until"].min()), mark + 1))
        elif state.exists:
            state.remove()
        if len(done):
            yield pd.DataFrame({
                "run": pd.Series([key[0]] * len(done), dtype=object), "window_id": done["window_id"].to_numpy(),
                "last_step": done["last_step"].to_numpy(), "mean_loss": (done["loss"] / done["n"]).to_numpy(),
                "instant_loss": done["instant_loss"].to_numpy(), "tokens": done["tokens"].to_numpy(),
                "seconds": done["seconds"].to_numpy(),
                "tokens_per_sec": np.where(done["seconds"] > 0, done["tokens"] / done["seconds"].where(done["seconds"] > 0, 1.0), 0.0)})
    return fold


def stream_windows(spark: SparkSession, in_path: str, out_path: str, checkpoint: str, schema, width: int = 10,
                   ts: str = "ts", delay: str = "1 hour", max_files_per_trigger: int = 4,
                   state_partitions: int | None = None) -> None:
    """Windows of ``width`` steps per run, appended once each when their last step arrives.

    State is kept for open windows only: a complete one is emitted and forgotten, and one whose rows
    are all older than the watermark (the newest ``ts`` less ``delay``) is dropped, so state does not grow with
    the log.  BLOCK_WINDOWS windows of a run share a key, so a trigger folds them in one call.  Rows older than the watermark are late and left out, as a window they would complete is gone.
    """
    ship_package(spark)
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(in_path)
    rows = src.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay).select(
        F.col("run").cast("bigint").alias("run"), F.expr(f"(step - 1) div {width}").cast("bigint").alias("window_id"),
        F.col("step").cast("bigint").alias("step"), F.col("loss").cast("double").alias("loss"), "tokens", "dt", ts,
        (F.unix_millis(ts) + 1).alias("until"))
    blocks = rows.withColumn("block", F.expr(f"window_id div {BLOCK_WINDOWS}"))
    out = blocks.groupBy("run", "block").applyInPandasWithState(
        _fold_windows(width), _WINDOW, _OPEN, "append", GroupStateTimeout.EventTimeTimeout)
    _run(out.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint)
         .outputMode("append"), spark=spark, state_partitions=state_partitions)
