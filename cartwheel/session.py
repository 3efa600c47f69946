"""Session helpers: one place for the configuration every job relies on.

Nothing here starts a server: the Spark UI stays off.  Scratch and checkpoint
data always go below the cluster's shared ``spark.checkpoint.dir``; a default
is set only when the session has none (tests, local runs).
"""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import SparkSession

_LOCAL_DEFAULT_CKPT = "/tmp/cartwheel-checkpoints"


def build_session(master: str | None = None, app: str = "cartwheel",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the library assumes."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # keyed streaming state (one entry per user) lives off-heap in RocksDB
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    target = configured or _LOCAL_DEFAULT_CKPT
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir() or target


def shared_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A folder below the shared checkpoint dir (never a machine-local tmp on a cluster)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    base = base.rstrip("/")
    leaf = list(parts)
    if unique:
        leaf.append(uuid.uuid4().hex[:12])
    return "/".join([base, "cartwheel", spark.sparkContext.applicationId] + leaf)


def clean_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote below ``shared_path`` (results read from there end with it)."""
    sc = spark.sparkContext
    base = (spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)).rstrip("/")
    path = sc._jvm.org.apache.hadoop.fs.Path("/".join([base, "cartwheel", sc.applicationId]))
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def local_fs_path(path: str) -> str:
    """Strip a ``file:`` scheme so local tests can inspect files directly."""
    return path[5:] if path.startswith("file:") else path


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Arrow batches of few rows, unless the session has chosen a number: rows here are whole documents."""
    if spark.conf.get(ARROW_ROWS) == "10000":  # Spark's default
        spark.conf.set(ARROW_ROWS, str(rows))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so Python functions find it there."""
    import tempfile
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_cartwheel_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="cartwheel-ship-"), "cartwheel.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(archive)
    sc._cartwheel_shipped = True
