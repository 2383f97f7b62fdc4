"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodestar.session import scratch_path

#: Text bytes that one call of a batch function sees at most by default (a single longer text comes alone).
SLICE_BYTES = 2 << 20

# The ASCII letters.
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z, all other characters kept (``lower`` would also change accented letters).

    Pure ASCII text takes the fast built-in ``lower``; the result is the same.
    """
    ascii_only = F.octet_length(c) == F.char_length(c)
    return F.when(ascii_only, F.lower(c)).otherwise(F.translate(c, _UPPER, _LOWER))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder under the shared checkpoint folder and read it back.

    Cuts the lineage at a written table, so a lost executor costs a re-read.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Steps:
    """Tables that an operator lands on its way; ``drop`` deletes them once nothing reads them any more."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path = spark, scratch_path(spark, f"llm-{name}")

    def land(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def sent(keys: DataFrame, most: int) -> DataFrame:
    """A stored key table, hinted for broadcast if it has at most ``most`` rows; else Spark shuffles."""
    return F.broadcast(keys) if keys.count() <= most else keys


def text_slices(batch: pa.RecordBatch, col: str, size: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Cut a batch into runs of rows with about ``size`` bytes of text; yields (rows, texts)."""
    if not batch.num_rows:
        return
    arr = batch.column(batch.schema.get_field_index(col))
    lens = pc.fill_null(pc.binary_length(arr), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lens) // size
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            rows = batch.slice(a, b - a)
            yield rows, rows.column(rows.schema.get_field_index(col)).to_pylist()


def fresh(taken, *names: str) -> list[str]:
    """The names, each lengthened until neither ``taken`` (columns, whatever their case) nor another one has it."""
    seen, out = {c.lower() for c in taken}, []
    for n in names:
        while n.lower() in seen:
            n += "_"
        seen.add(n.lower())
        out.append(n)
    return out


def map_texts(df: DataFrame, col: str, keep: list[str], schema: StructType | str,
              make: Callable[[], Callable[[list], list[pa.Array]]],
              slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Apply a batch function to a text column, one output row per input row.

    ``make()`` runs once per task and returns ``fn(texts) -> arrays`` for the
    fields of ``schema``; the columns ``keep`` are passed through unchanged in
    front.  An input column that carries a name of ``schema`` is not kept.  A text column that is kept
    is sent to the task once.
    """
    import pyspark.sql.types as T

    new = schema if isinstance(schema, StructType) else T._parse_datatype_string(schema)
    names = {f.name for f in new}
    keep = [k for k in keep if k not in names]
    kept_fields = [df.schema[k] for k in keep]
    out = StructType(kept_fields + list(new))
    text = col if col in keep else fresh(keep, "text")[0]
    extra = [] if col in keep else [F.col(f"`{col}`").alias(text)]
    src = df.select(*[F.col(f"`{k}`") for k in keep], *extra)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(out)

    def run(batches):
        fn = make()
        for batch in batches:
            for rows, texts in text_slices(batch, text, slice_bytes):
                cols = [rows.column(i) for i in range(len(keep))] + list(fn(texts))
                yield pa.RecordBatch.from_arrays(
                    [c if c.type == f.type else c.cast(f.type) for c, f in zip(cols, arrow)], schema=arrow)

    return src.mapInArrow(run, out)


def id_text(c: str = "doc_id") -> Column:
    """The id as text; a null id counts as the empty text."""
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def fold_of(c: str, n: int) -> Column:
    """crc32(id as text) mod n."""
    return F.crc32(id_text(c).cast("binary")) % n
