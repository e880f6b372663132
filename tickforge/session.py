"""Session construction and the few session-level settings the library reads."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Conf keys owned by this library (plain Spark conf entries, settable per session).
CHUNK_ROWS_KEY = "spark.tickforge.chunkRows"
FINE_BUCKETS_KEY = "spark.tickforge.fineBuckets"

DEFAULT_CHUNK_ROWS = 2_000_000
DEFAULT_FINE_BUCKETS = 16


def build_session(master: str | None = None, app: str = "tickforge",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
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
    return spark


def conf_int(spark: SparkSession, key: str, default: int) -> int:
    v = spark.conf.get(key, None)
    return int(v) if v not in (None, "") else default


def chunk_rows(spark: SparkSession) -> int:
    return conf_int(spark, CHUNK_ROWS_KEY, DEFAULT_CHUNK_ROWS)


def fine_buckets(spark: SparkSession) -> int:
    return conf_int(spark, FINE_BUCKETS_KEY, DEFAULT_FINE_BUCKETS)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster (spark.checkpoint.dir).

    Only a single-machine session (``local`` or ``local[n]``) that names none
    gets a private folder; every cluster, ``local-cluster`` included, must set it.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        d = tempfile.mkdtemp(prefix="tickforge-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    return os.path.join(checkpoint_dir(spark), name)


def path_kind(spark: SparkSession, path: str) -> str | None:
    """``folder``, ``file`` or None, in whatever store the path names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    return "folder" if fs.getFileStatus(p).isDirectory() else "file"


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where it does not exist."""
    if path_kind(spark, path) != "folder":
        return []
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(p)]


def remove_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder that this library has written, if it exists."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def touch(spark: SparkSession, path: str) -> None:
    """Creates an empty file, and the folders above it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True).close()
