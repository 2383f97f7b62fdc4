"""Teacher-vector source and sink for ``.npz`` files (member ``embeddings``).

A file is one binary row, so one task reads one file (files must stay under
the 2 GB row limit; land them as Parquet once for repeated use).  Row i of a
file is the vector of position ``start + i``, where ``start`` is encoded in
the file name written by :func:`write_npz`.
"""

from __future__ import annotations

import io
import os
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.session import qualified, ship_package

_NAME = re.compile(r"vectors-(\d+)\.npz$")


def write_npz(df: DataFrame, path: str, vec: str, pos: str = "pos", rows_per_file: int = 100_000) -> DataFrame:
    """Write ``vec`` as 2-D float32 ``embeddings`` arrays, one file per chunk of
    ``rows_per_file`` consecutive positions.  Returns (chunk, start, n) per file."""
    uri = qualified(df.sparkSession, path)
    uri = uri.replace("file:/", "file:///", 1) if re.match("file:/[^/]", uri) else uri

    def write_chunk(pdf: pd.DataFrame) -> pd.DataFrame:
        from pyarrow import fs as pafs

        pdf = pdf.sort_values(pos)
        start = int(pdf[pos].iloc[0])
        arr = np.stack(pdf[vec].to_numpy()).astype(np.float32)
        filesystem, root = pafs.FileSystem.from_uri(uri)
        filesystem.create_dir(root, recursive=True)
        final = f"{root}/vectors-{start:012d}.npz"
        tmp = f"{final}.tmp-{os.getpid()}"
        buf = io.BytesIO()
        np.savez(buf, embeddings=arr)
        with filesystem.open_output_stream(tmp) as fh:
            fh.write(buf.getvalue())
        filesystem.move(tmp, final)  # a retried task replaces the same name
        return pd.DataFrame({"chunk": [int(pdf["_chunk"].iloc[0])], "start": [start], "n": [len(pdf)]})

    ship_package(df.sparkSession)
    t = df.select(pos, vec).withColumn("_chunk", F.expr(f"`{pos}` div {rows_per_file}"))
    return t.groupBy("_chunk").applyInPandas(write_chunk, "chunk long, start long, n long")


def read_npz(spark: SparkSession, path: str, member: str = "embeddings") -> DataFrame:
    """(path, pos, embedding array<float>) from every ``*.npz`` file under ``path``."""
    ship_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").load(path).select("path", "content")

    def explode_files(it):
        for pdf in it:
            for p, content in zip(pdf["path"], pdf["content"]):
                arr = np.load(io.BytesIO(content))[member]
                m = _NAME.search(p)
                start = int(m.group(1)) if m else 0
                yield pd.DataFrame({"path": p, "pos": np.arange(start, start + arr.shape[0], dtype=np.int64),
                                    "embedding": list(arr.astype(np.float32))})

    return files.mapInPandas(explode_files, "path string, pos long, embedding array<float>")
