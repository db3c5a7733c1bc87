"""Session settings that the jobs rely on, and the shared folder for intermediate tables."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: All of these can be set on a running session.
SETTINGS = {
    # Offsets in the exports are converted to instants; UTC keeps dates the same everywhere.
    "spark.sql.session.timeZone": "UTC",
    # A malformed number must fail the load instead of turning into NULL.
    "spark.sql.ansi.enabled": "true",
    # Runtime re-planning: joins by measured size, and splitting of hot join keys, also where
    # the split costs one more exchange further up.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM never compiles methods of more than 8000 bytes. Cleaning a wide table in one
    # generated method would be interpreted; beyond this size Spark splits it up instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Stored tables and intermediate ones are mostly text: these files are a fraction of snappy's.
    "spark.sql.parquet.compression.codec": "zstd",
}

#: Can only be set when the session is started.
START_SETTINGS = {
    # Recording the Python call site of every column expression takes longer than planning.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def start(builder: SparkSession.Builder) -> SparkSession:
    """A session with all settings. Any other session works as well, after :func:`prepare`."""
    for name, value in {**START_SETTINGS, **SETTINGS}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def size_shuffles(
    spark: SparkSession, largest_shuffle_bytes: int, partition_bytes: int = 256 * 1024 * 1024
) -> int:
    """Set the partitions of a shuffle so that each fits into the memory of a task.

    Size them for the largest shuffle of the job; AQE merges the partitions of smaller ones. The
    default of Spark, 200, would give partitions of 50 GB for a shuffle of 10 TB.
    """
    wanted = -(-largest_shuffle_bytes // partition_bytes)
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
    return partitions


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a session in one process (``local`` or ``local[n]``) without that setting gets a temporary
    folder of its own. (A ``file:`` path in the setting may be a mount that all machines share.)
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="dealtide-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: Setting of the session: the folder of the tables that the work in progress stores.
_SCOPE = "dealtide.tables"


def _file_system(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    path, files = _file_system(spark, path)
    return files.exists(path)


def path_bytes(spark: SparkSession, path: str) -> int:
    path, files = _file_system(spark, path)
    return files.getContentSummary(path).getLength()


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    path, files = _file_system(spark, path)
    files.delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished work. Spark deletes those of plans that the driver no longer holds, but
    only when the driver's garbage happens to be collected; until then they fill the executors' disks."""
    gc.collect()
    spark._jvm.System.gc()


@contextmanager
def stored_until_done(spark: SparkSession) -> Iterator[None]:
    """Tables that :func:`store` writes inside are deleted at the end.

    For work that writes its result elsewhere. One such piece of work at a time in a session.
    """
    folder = f"{shared_folder(spark)}/dealtide-tables/work-{uuid.uuid4().hex}"
    before = spark.conf.get(_SCOPE, None)
    spark.conf.set(_SCOPE, folder)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SCOPE)
        else:
            spark.conf.set(_SCOPE, before)
        delete_path(spark, folder)


def store(df: DataFrame, *measures: Column) -> tuple[DataFrame, dict]:
    """Write an intermediate table to the shared folder, and measure it while it is written.

    Returns the stored table, which later steps read instead of computing it again (also when an
    executor is lost), and the values of the aggregates ``measures``.
    """
    spark = df.sparkSession
    folder = spark.conf.get(_SCOPE, None) or f"{shared_folder(spark)}/dealtide-tables"
    path = f"{folder}/{uuid.uuid4().hex}"
    seen = Observation()
    measures = measures or (F.count(F.lit(1)).alias("rows"),)
    df.observe(seen, *measures).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen.get
