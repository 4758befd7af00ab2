"""Spark session and shared-folder helpers.

Written tables and checkpoints go under the folder the cluster names in
``spark.checkpoint.dir``. Only when that is unset and Spark runs in local mode
(tests, single-machine benches) do we create one of our own under /tmp.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Written tables: about two thirds of the bytes of Spark's default.
COMPRESSION = "zstd"

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoints of ranks and basket items are dropped once unreachable.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "txnlake",
              shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Session with the settings the library is tested under."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master  # local-cluster has executors of its own
    return master == "local" or master.startswith("local[")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session, set up if needed."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or \
        spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a shared folder is required on a cluster")
        configured = tempfile.mkdtemp(prefix="txnlake-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex[:12]}")


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, with
    statistics and column pruning for every reader, and safe from lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_DROPS: dict[str, list] = {}  # by session: how many blocks are open, and the setting before the first
_DROPS_LOCK = threading.Lock()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes (and other actions on frames made) in here delete their shuffle
    files when they end. Left alone these stay until the driver's garbage
    collector finds them unreachable, so a run of many stages holds all of them
    on disk at once. Should a frame made in here be evaluated again, Spark
    computes the missing files again. Return no such frame to a caller."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    session = spark._jsparkSession.sessionUUID()
    with _DROPS_LOCK:
        _DROPS.setdefault(session, [0, spark.conf.get(key)])[0] += 1
        spark.conf.set(key, "true")
    try:
        yield
    finally:
        with _DROPS_LOCK:  # views run in threads: the last block to end restores
            _DROPS[session][0] -= 1
            if not _DROPS[session][0]:
                spark.conf.set(key, _DROPS.pop(session)[1])


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
