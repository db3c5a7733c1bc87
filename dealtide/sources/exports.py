"""CSV exports as raw tables: all columns text, the header checked against the model."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from dealtide.model import RAW_COLUMNS, raw_schema


def read_raw(
    spark: SparkSession, path: str, table: str, multiline: bool = False, strict: bool = True
) -> DataFrame:
    """One raw table from a CSV file or a folder of CSV files.

    An unquoted empty field is NULL, a quoted one the empty string. A file with another header
    fails. ``strict`` also fails on rows with too few or too many fields; otherwise missing ones
    are NULL. A field with a line break needs ``multiline``, which makes one task of each file;
    without it large files are split, and such a field leaves rows too short, which ``strict`` finds.
    """
    return (
        spark.read.schema(raw_schema(table))
        .option("header", True)
        .option("enforceSchema", False)
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .option("multiLine", multiline)
        # A character that no export holds: without it both kinds of empty fields are NULL.
        .option("nullValue", "\u0000")
        .option("emptyValue", "")
        .option("mode", "FAILFAST" if strict else "PERMISSIVE")
        .csv(path)
    )


def read_exports(
    spark: SparkSession, folder: str, tables: Iterable[str] = RAW_COLUMNS, **options
) -> dict[str, DataFrame]:
    """All raw tables of a folder with one ``<table>.csv`` (file or folder) each."""
    return {t: read_raw(spark, f"{folder}/{t}.csv", t, **options) for t in tables}
