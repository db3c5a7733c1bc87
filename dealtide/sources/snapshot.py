"""Snapshots: one Parquet folder per table and a manifest that is written last.

Every run writes to a folder of its own, so that a refresh never destroys what is being read,
and a run without a manifest is known to be unfinished. The manifest holds a fingerprint of every
table, and how many of its rows break a constraint on their own, measured while it was written.

Tables that reports read by period are partitioned by the month of a date, in place of an index on it.
The month is not a column of the table: :meth:`Snapshot.between` filters by it before it is left out.

Deals and their children can be bucketed by ``deal_id``, in place of an index on it: they are joined and
grouped by it without a shuffle. A table whose buckets a hot deal makes uneven is read without them.
"""

from __future__ import annotations

import datetime
import json
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealtide.model import TABLES
from dealtide.operators import digests, rules
from dealtide.operators.findings import with_fields
from dealtide.session import delete_path, path_bytes, path_exists
from dealtide.sources import buckets as bucketed

_MANIFEST = "_manifest"
_MANIFEST_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("layer", T.StringType(), False),
    T.StructField("table_name", T.StringType(), False),
    T.StructField("row_count", T.LongType(), False),
    T.StructField("table_schema", T.StringType(), False),
    T.StructField("digests", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("month_of", T.StringType(), True),
    T.StructField("bucket_of", T.StringType(), True),
    T.StructField("buckets", T.IntegerType(), True),
    T.StructField("broken", T.MapType(T.StringType(), T.LongType()), True),
])

#: Tables of the layer ``main`` that are partitioned, and the column whose month it is.
MONTH_OF = {"deals": "created_at", "marketing_costs": "cost_date"}
MONTH = "_month"

#: Tables of the layer ``main`` that can be bucketed, and the column.
BUCKET_OF = {
    table: "deal_id"
    for table in (
        "deals", "deal_products", "payments", "activities", "stage_history", "production_orders", "shipments",
    )
}
VERIFIED_AT_ONCE = 4
#: Bytes of the largest table in each bucket.
BUCKET_BYTES = 64 * 1024 * 1024

Day = datetime.date | datetime.datetime | str | None


def _groups(layer: str, table: str, columns: list[str]) -> dict[str, list[str]]:
    key = TABLES[table].key if layer == "main" and table in TABLES else ()
    return digests.groups_of(columns, key)


def _month(instant: Column) -> Column:
    return F.date_format(instant, "yyyy-MM")


@dataclass(frozen=True)
class Layout:
    """How a table is stored: by the month of a date, and in buckets of a key."""

    month_of: str | None = None
    bucket_of: str | None = None
    buckets: int | None = None


class SnapshotWriter:
    """Writes the tables of one run; :meth:`finish` makes the snapshot valid.

    A run has a folder of its own. One that exists is refused: its manifest, if there is one, tells
    about other tables. ``buckets``: into how many the tables in :data:`BUCKET_OF` are divided, the same
    number for all; None for none. ``tables``: what has been written of the layer ``main``.
    """

    def __init__(self, spark: SparkSession, folder: str, run_id: str, buckets: int | None = None):
        self.spark = spark
        self.folder = f"{folder.rstrip('/')}/{run_id}"
        self.run_id = run_id
        self.buckets = buckets
        self.tables = Snapshot()
        self._written: list[tuple] = []
        if path_exists(spark, self.folder):
            raise ValueError(f"{self.folder} exists: every run needs a run_id of its own")

    def write(self, layer: str, table: str, df: DataFrame) -> DataFrame:
        """Write a table, fingerprint it on the way, and read it back: what follows does not compute it
        again. A partitioned table is dealt out by month first; AQE splits months with many rows
        and joins those with few, so that neither tasks nor files grow with a hot month. A bucketed one
        is dealt out by its key, likewise."""
        path = f"{self.folder}/{layer}/{table}"
        groups, seen = _groups(layer, table, df.columns), Observation()
        layout = self._layout(layer, table, df.columns)
        of_rules = rules.measures(TABLES[table], df.columns) if layer == "main" and table in TABLES else []
        rows = df.observe(seen, *digests.measures(groups), *of_rules)
        if layout.month_of:
            rows = rows.withColumn(MONTH, _month(F.col(layout.month_of)))
        partition = MONTH if layout.month_of else None
        if layout.buckets:
            bucketed.write_bucketed(rows, path, layout.bucket_of, layout.buckets, partition)
            if not bucketed.are_even(self.spark, path, df.schema, layout.buckets):
                layout = replace(layout, bucket_of=None, buckets=None)
        elif partition:
            rows.hint("rebalance", F.col(MONTH)).write.partitionBy(MONTH).parquet(path)
        else:
            rows.write.parquet(path)
        measured = seen.get
        broken = rules.broken(measured) if of_rules else None
        self._written.append((
            self.run_id, layer, table, measured[digests.ROWS], df.schema.json(), digests.digests(measured, groups),
            layout.month_of, layout.bucket_of, layout.buckets, broken,
        ))
        written = Snapshot() if layer != "main" else self.tables
        written.add(table, _read(self.spark, path, df.schema, layout), layout, broken)
        return written[table]

    def _layout(self, layer: str, table: str, columns: list[str]) -> Layout:
        if layer != "main":
            return Layout()
        month_of, bucket_of = MONTH_OF.get(table), BUCKET_OF.get(table)
        return Layout(
            month_of if month_of in columns else None,
            *((bucket_of, self.buckets) if self.buckets and bucket_of in columns else (None, None)),
        )

    def use_buckets(self, largest: int | None = None, least: int = 1) -> int:
        """Choose the number of buckets by the size of the largest table, by default of those written so
        far: a power of two, so that the buckets of a larger run are parts of those of a smaller one."""
        largest = self.largest_bytes() if largest is None else largest
        wanted = max(least, -(-largest // BUCKET_BYTES), 1)
        self.buckets = 1 << (wanted - 1).bit_length()
        return self.buckets

    def largest_bytes(self) -> int:
        """Size of the largest table that was written."""
        sizes = [path_bytes(self.spark, f"{self.folder}/{w[1]}/{w[2]}") for w in self._written]
        return max(sizes, default=0)

    def finish(self) -> None:
        manifest = self.spark.createDataFrame(self._written, _MANIFEST_SCHEMA)
        manifest.coalesce(1).write.json(f"{self.folder}/{_MANIFEST}")


def _read(spark: SparkSession, path: str, schema: T.StructType, layout: Layout) -> DataFrame:
    partition = MONTH if layout.month_of else None
    if partition:
        schema = T.StructType([*schema.fields, T.StructField(MONTH, T.StringType())])
    if layout.buckets:
        return bucketed.read_bucketed(spark, path, schema, layout.bucket_of, layout.buckets, partition)
    return spark.read.schema(schema).parquet(path)


class Snapshot(dict):
    """Tables of a finished run by name. :meth:`between` reads a period of one.

    ``broken``: of tables whose contents are known to be those that were written, ``rule.column`` -> rows
    that break it. A table that is put in place of a stored one is known by its rows alone.
    """

    def __init__(self):
        super().__init__()
        self._by_month: dict[str, tuple[DataFrame, str]] = {}
        self._buckets: dict[str, tuple[str, int]] = {}
        self.broken: dict[str, dict[str, int]] = {}

    def __setitem__(self, name: str, rows: DataFrame) -> None:
        for known in (self._by_month, self._buckets, self.broken):
            known.pop(name, None)
        super().__setitem__(name, rows)

    def add(self, name: str, stored: DataFrame, layout: Layout, broken: dict[str, int] | None = None) -> None:
        self[name] = stored.drop(MONTH) if layout.month_of else stored
        if broken is not None:
            self.broken[name] = broken
        if layout.month_of:
            self._by_month[name] = stored, layout.month_of
        if layout.buckets:
            self._buckets[name] = layout.bucket_of, layout.buckets

    def together(self, name: str, column: str, other: str, key: str) -> bool:
        """Do equal values of ``column`` and of the other table's ``key`` lie in the same bucket?"""
        own, others = self._buckets.get(name), self._buckets.get(other)
        return own is not None and others is not None and own[0] == column and others == (key, own[1])

    def stored(self, name: str) -> DataFrame:
        """A table as it is stored: with the month that it is partitioned by, if there is one."""
        return self._by_month[name][0] if name in self._by_month else self[name]

    def between(self, name: str, column: str, start: Day, end: Day) -> DataFrame:
        """Rows with ``start <= column < end``; a bound that is None does not count. If the table is
        partitioned by the month of that column, only the months of the period are read: none of rows
        without a date, which have a partition of their own."""
        stored, month_of = self._by_month.get(name, (self[name], None))
        if column == month_of:
            if start is not None:
                stored = stored.filter(F.col(MONTH) >= _month(instant(start)))
            if end is not None:
                stored = stored.filter(F.col(MONTH) <= _month(instant(end) - F.expr("INTERVAL 1 MICROSECOND")))
        return period(stored, column, start, end).select(*self[name].columns)


def instant(bound: Day) -> Column:
    return F.lit(str(bound)).cast("timestamp")


def period(df: DataFrame, column: str, start: Day, end: Day) -> DataFrame:
    """Rows with ``start <= column < end``."""
    if start is not None:
        df = df.filter(F.col(column) >= instant(start))
    if end is not None:
        df = df.filter(F.col(column) < instant(end))
    return df


def read_manifest(spark: SparkSession, run_folder: str) -> DataFrame:
    return spark.read.schema(_MANIFEST_SCHEMA).json(f"{run_folder.rstrip('/')}/{_MANIFEST}")


def read_snapshot(
    spark: SparkSession, run_folder: str, layer: str = "main", verify: bool = False
) -> Snapshot:
    """The tables of one layer of a finished run. ``verify`` reads them all and compares their
    fingerprints with the manifest's."""
    run_folder = run_folder.rstrip("/")
    tables = Snapshot()
    found = read_manifest(spark, run_folder).filter(F.col("layer") == layer).collect()
    for entry in found:
        schema = T.StructType.fromJson(json.loads(entry.table_schema))
        layout = Layout(entry.month_of, entry.bucket_of, entry.buckets)
        stored = _read(spark, f"{run_folder}/{layer}/{entry.table_name}", schema, layout)
        tables.add(entry.table_name, stored, layout, entry.broken if verify else None)
    if verify:
        with ThreadPoolExecutor(VERIFIED_AT_ONCE) as jobs:
            list(jobs.map(lambda entry: _verify(tables[entry.table_name], entry), found))
    return tables


def _verify(table: DataFrame, entry) -> None:
    name = entry.table_name
    count, found = digests.fingerprint(table, _groups(entry.layer, name, table.columns))
    if count != entry.row_count:
        raise ValueError(f"{name} has {count} rows, not {entry.row_count}")
    wrong = sorted(g for g, d in (entry.digests or {}).items() if found.get(g) != d)
    if wrong:
        what = "keys" if "key" in wrong else "values"
        raise ValueError(f"{name} has other {what} than were written")


def compare_runs(spark: SparkSession, one: str, other: str) -> DataFrame:
    """layer, table_name, and what differs between two runs: ``rows_before``, ``rows_after``, ``same_keys``
    (NULL without a key) and ``same_values``. Only the manifests are read, whatever the tables' size."""
    def side(folder: str, name: str) -> DataFrame:
        return read_manifest(spark, folder).select(
            "layer", "table_name", F.col("row_count").alias(f"rows_{name}"),
            F.col("digests")["key"].alias(f"key_{name}"), F.col("digests")["row"].alias(f"row_{name}"),
        )

    both = side(one, "before").join(side(other, "after"), ["layer", "table_name"], "full")
    return both.select(
        "layer", "table_name", "rows_before", "rows_after",
        (F.col("key_before") == F.col("key_after")).alias("same_keys"),
        F.coalesce((F.col("row_before") == F.col("row_after")) & (F.col("rows_before") == F.col("rows_after")), F.lit(False)).alias("same_values"),
    )


# ---- the journal of all runs --------------------------------------------------------------

#: The source row of an entry as a VARIANT, beside its text.
RAW = "raw"


def append_journal(rejects: DataFrame, folder: str, run_id: str) -> None:
    """Add the journal of a run to that of all runs, below ``folder``: a partition for each run.

    A run that is added again replaces its own entries and no others, also by none at all. The source rows
    are stored as text and as VARIANT, so that a field of them is read without parsing the row.
    """
    entries = rejects.filter(F.col("run_id") == run_id).withColumn(RAW, F.try_parse_json("raw_data"))
    writer = entries.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if entries.isEmpty():
        delete_path(rejects.sparkSession, f"{folder.rstrip('/')}/run_id={run_id}")
    else:
        writer.partitionBy("run_id").parquet(folder)


def read_journal(spark: SparkSession, folder: str, fields: Mapping[str, str] | None = None) -> DataFrame:
    """The entries of all runs in the columns of the journal. A filter on ``run_id`` reads only its runs.

    ``fields``: column names and the fields of the source row that they take, see
    :func:`dealtide.operators.findings.with_fields`.
    """
    schema = TABLES["rejects"].schema
    if not path_exists(spark, folder):
        stored = spark.createDataFrame([], schema).withColumn(RAW, F.try_parse_json("raw_data"))
    else:
        stored = spark.read.schema(T.StructType([*schema.fields, T.StructField(RAW, T.VariantType())])).parquet(folder)
    return with_fields(stored, fields or {}, F.col(RAW)).select(*schema.fieldNames(), *(fields or {}))
