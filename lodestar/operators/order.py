"""Global order: dense positions, seeded shuffle, fixed-size and epoch batching.

``with_positions`` gives every row its 0-based rank in a total order without
a window over one partition:

1. range-partition on the order keys and sort within partitions;
2. checkpoint to the shared folder, which fixes the partition boundaries (a
   re-sampled range partitioner would move them) and cuts lineage;
3. ``monotonically_increasing_id`` carries (partition, index in partition);
4. one count per partition, prefix-summed over a table of at most
   ``spark.sql.shuffle.partitions`` rows, broadcast back.

The only data-sized shuffle is the range exchange, which balances itself by
sampling, so a hot key range is split over many tasks.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lodestar.functions.random import hash_key
from lodestar.session import checkpoint_root, shuffle_partitions, ship_package

_LOW33 = (1 << 33) - 1


def _cols(keys) -> list[Column]:
    return [F.col(k) if isinstance(k, str) else k for k in keys]


def _small(offsets: DataFrame, gcols) -> DataFrame:
    """Broadcast hint for an offset table that has one row per partition; with groups the number
    of rows grows with the groups, and Spark decides by its size."""
    return offsets if gcols else F.broadcast(offsets)


def with_positions(df: DataFrame, order_by, pos: str = "pos", group_by=(),
                   partitions: int | None = None) -> DataFrame:
    """Add ``pos``: 0-based dense rank of each row in ``order_by`` order.

    ``group_by`` restarts the numbering per group (the groups should be few,
    e.g. corpus versions; for many small groups use a window instead).
    The order keys must make the order total, or ties are broken arbitrarily.
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    n = partitions or shuffle_partitions(spark)
    gcols = list(group_by)
    keys = _cols(gcols) + _cols(order_by)
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    fixed = ranged.checkpoint(eager=True)
    mid = F.monotonically_increasing_id()
    tagged = (fixed.withColumn("_mid", mid)
              .withColumn("_pid", F.shiftright("_mid", 33))
              .withColumn("_loc", F.col("_mid").bitwiseAND(F.lit(_LOW33))))
    # Per (partition, group): first local index and row count.  With groups,
    # a partition may hold several groups, so the local index is re-based.
    counts = tagged.groupBy("_pid", *gcols).agg(F.count(F.lit(1)).alias("_n"),
                                               F.min("_loc").alias("_first"))
    w = Window.partitionBy(*gcols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    out = (tagged.join(_small(offsets.select("_pid", *gcols, "_off", "_first"), gcols), ["_pid", *gcols])
           .withColumn(pos, (F.col("_off") + F.col("_loc") - F.col("_first")).cast("bigint"))
           .drop("_mid", "_pid", "_loc", "_off", "_first"))
    return out


def global_from_group_positions(df: DataFrame, group: str, pos: str, out: str = "gpos") -> DataFrame:
    """Global dense position from positions that are already dense inside each
    group: ``pos + rows of the earlier groups`` (groups ordered by value).

    Only a per-group count table is aggregated (map-side partial counts), so no
    data-sized sort is needed.  Meant for few groups (versions, runs).
    """
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy(group).rowsBetween(Window.unboundedPreceding, -1)  # one row per group
    offs = counts.withColumn("_goff", F.coalesce(F.sum("_n").over(w), F.lit(0))).select(group, "_goff")
    return (df.join(F.broadcast(offs), group)  # a row per group: joined by a shuffle, a group would meet in one task
            .withColumn(out, (F.col("_goff") + F.col(pos)).cast("bigint")).drop("_goff"))


def shuffle(df: DataFrame, key, seed: int = 42, pos: str = "pos") -> DataFrame:
    """Seeded global permutation: order by ``md5(seed|shuffle|key)``, then key."""
    k = F.col(key) if isinstance(key, str) else key
    tmp = df.withColumn("_skey", hash_key(seed, "shuffle", k))
    return with_positions(tmp, ["_skey", k], pos=pos).drop("_skey")


def batch_fixed(df: DataFrame, pos: str, size: int, drop_remainder: bool = False) -> DataFrame:
    """``batch_id = pos div size``, ``slot = pos mod size``; the tail batch is kept."""
    out = (df.withColumn("batch_id", F.expr(f"`{pos}` div {size}"))
           .withColumn("slot", F.pmod(F.col(pos), F.lit(size)).cast("bigint")))
    if drop_remainder:
        n = df.agg(F.count(F.lit(1))).first()[0]
        out = out.filter(F.col("batch_id") < F.lit(n // size))
    return out


def batch_epochs(df: DataFrame, pos: str, size: int, epochs: int, n_rows: int | None = None,
                 reshuffle_key: str | None = None, seed: int = 42) -> DataFrame:
    """Repeat the data ``epochs`` times in the same order; batches straddle epochs.

    ``gpos = epoch * N + pos``.  With ``reshuffle_key`` each epoch gets its own
    seeded order (``seed + epoch``), as a fresh stream per epoch does.
    """
    if n_rows is None:
        n_rows = df.agg(F.count(F.lit(1))).first()[0]
    rep = df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    rep = rep.withColumn("epoch", F.col("epoch").cast("bigint"))
    if reshuffle_key is not None:
        rep = rep.drop(pos).withColumn(
            "_skey", hash_key(seed, "epoch", F.col("epoch"), F.col(reshuffle_key)))
        rep = with_positions(rep, ["_skey", reshuffle_key], pos=pos, group_by=["epoch"]).drop("_skey")
    rep = rep.withColumn("gpos", F.col("epoch") * F.lit(n_rows) + F.col(pos))
    return (rep.withColumn("batch_id", F.expr(f"gpos div {size}"))
            .withColumn("slot", F.pmod(F.col("gpos"), F.lit(size)).cast("bigint")))


def micro_split(df: DataFrame, g: int, batch_id: str = "batch_id", slot: str = "slot",
                batch_rows: str | None = None) -> DataFrame:
    """Split each batch of n rows into ``g`` micro-batches of ``m = n div g`` rows.

    Only the first ``g*m`` rows of a batch are kept (the reference drops the
    ``n mod g`` tail); ``m = 0`` keeps nothing.  ``batch_rows`` names a column
    holding n; otherwise it is counted with a window over the batch.
    """
    n = F.col(batch_rows) if batch_rows else F.count(F.lit(1)).over(Window.partitionBy(batch_id))
    out = df.withColumn("_n", n).withColumn("_m", F.expr(f"_n div {g}")).drop("_n").filter(F.col("_m") > 0)
    out = out.withColumn("micro_id", F.expr(f"`{slot}` div _m"))
    return out.filter(F.col("micro_id") < g).drop("_m")


def running_agg(df: DataFrame, order_by, value: str, group_by=(), how: str = "sum",
                inclusive: bool = True, out: str | None = None, partitions: int | None = None) -> DataFrame:
    """Running sum or max of ``value`` in ``order_by`` order within each group.

    Rows are range-partitioned on (group, order), sorted and checkpointed.  A first pass over the sorted
    partitions gives one row per partition: its first and last group with their totals.  Folded in
    order, these say what a partition's first group has gathered before it, which is all
    that a second pass needs to scan its rows from top to bottom.  No row moves after the
    checkpoint, a group may hold any share of the rows, and only one row per partition reaches the driver.

    Nulls are skipped; the result is null until a group's first value.  ``inclusive=False`` gives the
    value over strictly earlier rows.
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    ship_package(spark)
    n = partitions or shuffle_partitions(spark)
    out = out or f"running_{how}_{value}"
    gcols = list(group_by)
    keys = _cols(gcols) + _cols(order_by)
    fixed = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).checkpoint(eager=True)
    kind = df.select((F.sum if how == "sum" else F.max)(value).alias(out)).schema[0].dataType
    narrow = fixed.select(F.spark_partition_id().alias("_pid"), *gcols, F.col(value).cast(kind).alias("_v"))
    edges = narrow.mapInArrow(_edges(gcols, how), "edge binary").collect()  # one row per partition
    before, group, total = {}, None, None
    for pid, first, first_total, last, last_total in sorted(
            (pickle.loads(r["edge"]) for r in edges), key=lambda e: e[0]):
        carried = total if group == (first,) else None
        before[pid] = carried
        total = _fold(carried, last_total, how) if first == last else last_total
        group = (last,)
    t = fixed.withColumn(out, F.lit(None).cast(kind)).withColumn("_pid", F.spark_partition_id()).withColumn(
        "_v", F.col(value).cast(kind))
    schema = StructType(t.schema.fields[:-2])
    return t.mapInArrow(_scan(gcols, how, inclusive, out, before, to_arrow_schema(schema)), schema)


def _fold(a, b, how: str):
    """Sum or maximum of two values, either of which may be missing."""
    if a is None or b is None:
        return b if a is None else a
    return a + b if how == "sum" else max(a, b)


def _segments(batch: pa.RecordBatch, gcols: list[str]):
    """(group, start, end) of the runs of equal groups in a batch."""
    change = np.zeros(batch.num_rows, bool)
    for g in gcols:
        codes = batch.column(g).dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
        change[1:] |= codes[1:] != codes[:-1]
    cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield tuple(batch.column(g)[a].as_py() for g in gcols), a, b


def _total(column: pa.Array, how: str):
    return (pc.sum if how == "sum" else pc.max)(column).as_py()


def _edges(gcols, how):
    """One pickled row per partition: number, first group and its total, last group and its total."""
    def run(batches):
        pid = first = last = None
        first_total = total = None
        for batch in batches:
            for group, a, b in _segments(batch, gcols) if batch.num_rows else ():
                pid = batch.column("_pid")[0].as_py()
                part = _total(batch.column("_v").slice(a, b - a), how)
                if last is None:
                    first = last = group
                    total = part
                elif group == last:
                    total = _fold(total, part, how)
                else:
                    last, total = group, part
                if group == first:
                    first_total = total
        if last is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([pickle.dumps((pid, first, first_total, last, total))], pa.binary())], ["edge"])
    return run


def _running(column: pa.Array, start, how: str, inclusive: bool) -> tuple[list, object]:
    """Running values of one run of rows, from ``start``, and the value after it."""
    v = column if column.null_count else column.to_numpy(zero_copy_only=False)
    if column.null_count or v.dtype == object:
        got, at = [], start
        for x in column.to_pylist():
            before, at = at, _fold(at, x, how)
            got.append(at if inclusive else before)
        return got, at
    if start is not None:
        v = np.concatenate([np.array([start], v.dtype), v])
    run = np.cumsum(v) if how == "sum" else np.maximum.accumulate(v)
    end = run[-1].item()
    if inclusive:
        return (run if start is None else run[1:]).tolist(), end
    return ([None, *run[:-1].tolist()] if start is None else run[:-1].tolist()), end


def _scan(gcols, how, inclusive, out, before, schema):
    def run(batches):
        at = group = None
        begun = False
        for batch in batches:
            if not batch.num_rows:
                continue
            values: list = []
            for g, a, b in _segments(batch, gcols):
                if not begun:
                    at, begun = before.get(batch.column("_pid")[0].as_py()), True
                elif g != group:
                    at = None
                group = g
                got, at = _running(batch.column("_v").slice(a, b - a), at, how, inclusive)
                values += got
            cols = [pa.array(values, f.type) if f.name == out else batch.column(f.name) for f in schema]
            yield pa.RecordBatch.from_arrays(
                [c if c.type == f.type else c.cast(f.type) for c, f in zip(cols, schema)], schema=schema)
    return run
