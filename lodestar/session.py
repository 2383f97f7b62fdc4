"""Session construction and the shared scratch folder.

Intermediate tables (landed fixtures, stream inputs, checkpoints) always go
under the folder the cluster names in ``spark.checkpoint.dir``.  A folder of
our own is only chosen when that setting is absent, which is the case in
local tests.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Joins on (group, qi[, di]) of data already hash-partitioned by the group
    # key (in-batch pairs) keep that partitioning instead of re-shuffling.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Checkpoint files go once their DataFrame is no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "lodestar", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_LOCAL_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("LODESTAR_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    ship_package(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a local one only when none is configured."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if root:
        if not current:
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    # Unset, and driver and executors are one process: tests and benches.
    root = tempfile.mkdtemp(prefix="lodestar-ckpt-", dir="/tmp")
    sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/lodestar-scratch/{name}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder made by ``scratch_path`` once nothing reads it any more."""
    if not path.startswith(f"{checkpoint_root(spark)}/lodestar-scratch/"):
        raise ValueError(f"not a scratch folder: {path}")
    p, fs = _hadoop_path(spark, path)
    fs.delete(p, True)


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """Within it, the shuffle files of an execution go when it ends; else they stay until the driver
    happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def broadcast_row_limit(spark: SparkSession, row_bytes: int) -> int:
    """Rows that fit under the session's broadcast threshold at ``row_bytes`` each."""
    thr = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760"))
    if thr.startswith("-"):
        return 0
    thr_b = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(thr)
    if thr_b <= 0:
        return 0
    return max(1, thr_b // max(1, row_bytes))


def _hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme; one without a scheme belongs to the default filesystem."""
    p, fs = _hadoop_path(spark, path)
    return p.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString()


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    p, fs = _hadoop_path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(data)
    finally:
        out.close()


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``lodestar`` importable in executor Python workers (once per application).

    Operators that run Python on executors (pandas UDFs, applyInPandas,
    mapInPandas) pickle references to this package; the package is zipped and
    registered with ``addPyFile``, which copies it to every executor.
    """
    import io
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for cur, dirs, files in os.walk(pkg_dir):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(cur, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    # Written into the shared checkpoint folder through Hadoop; addPyFile copies it to executors.
    target = f"{scratch_path(spark, 'pyfiles')}/lodestar.zip"
    write_bytes(spark, target, buf.getvalue())
    sc.addPyFile(qualified(spark, target))
    _SHIPPED.add(key)
