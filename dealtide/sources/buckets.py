"""Bucketed Parquet folders: tables that are joined and grouped by one key without a shuffle.

Spark knows buckets only of tables in its catalog. A folder is therefore registered for as long as it
takes to write it or to make a DataFrame of it; nothing stays in the catalog, and any session that
knows the number of buckets can read the folder again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A bucket is one task of the reading stage. Buckets count as even if none has more than this many rows,
#: or none more than so many times the average.
SMALL_BUCKET = 1_000_000
MAX_UNEVEN = 4

#: The partitions of a folder are found by listing it, not in the catalog: the entry there is short-lived.
_LISTED = ("spark.sql.hive.manageFilesourcePartitions", "false")
_setting = Lock()


@contextmanager
def _registered(
    spark: SparkSession, path: str, schema: T.StructType, column: str, buckets: int, partition: str | None
) -> Iterator[tuple[str, DataFrame]]:
    """Name and DataFrame of the folder as a table of the catalog."""
    name = f"dealtide_{uuid.uuid4().hex}"
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = f"PARTITIONED BY (`{partition}`)" if partition else ""
    setting, listed = _LISTED
    with _setting:
        before = spark.conf.get(setting)
        spark.conf.set(setting, listed)
        try:
            spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet {by}"
                f" CLUSTERED BY (`{column}`) INTO {buckets} BUCKETS LOCATION '{location}'"
            )
            table = spark.table(name)  # resolved, and with it how its files are found
        finally:
            spark.conf.set(setting, before)
    try:
        yield name, table
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # the files stay: they are not the catalog's


def write_bucketed(
    rows: DataFrame, path: str, column: str, buckets: int, partition: str | None = None
) -> None:
    """Write ``rows`` into a new folder, in ``buckets`` by a hash of ``column``; ``partition``, the last
    column, becomes a folder of each of its values.

    The rows are dealt out as the buckets are, with a rebalance hint: AQE gives several small buckets
    to one task and splits a large one over several, so that a hot key does not make a long task here.
    A bucket has as many files as tasks wrote it.
    """
    spark = rows.sparkSession
    dealt = rows.hint("rebalance", buckets, F.col(column))
    with _registered(spark, path, rows.schema, column, buckets, partition) as (name, _):
        dealt.write.insertInto(name)


def read_bucketed(
    spark: SparkSession, path: str, schema: T.StructType, column: str, buckets: int, partition: str | None = None
) -> DataFrame:
    """The table of such a folder. Spark reads a bucket in one task where that saves a shuffle, and splits
    the files as usual where it does not."""
    with _registered(spark, path, schema, column, buckets, partition) as (_, table):
        return table


def are_even(spark: SparkSession, path: str, schema: T.StructType, buckets: int) -> bool:
    """Can each bucket be read in one task? Not if a hot key makes one much larger than the others.

    Counts rows by file: no column is read. One row for each file is shuffled.
    """
    rows = spark.read.schema(schema).parquet(path).groupBy(F.col("_metadata.file_name").alias("file")).count()
    # part-<task>-<id>_<bucket>.c000.<codec>.parquet
    bucket = F.regexp_extract("file", r"_(\d+)(?:\.[^/]*)?$", 1)
    sizes = rows.groupBy(bucket).agg(F.sum("count").alias("rows")).agg(F.max("rows"), F.sum("rows")).first()
    largest, total = sizes[0] or 0, sizes[1] or 0
    return largest <= max(SMALL_BUCKET, MAX_UNEVEN * total / buckets)
