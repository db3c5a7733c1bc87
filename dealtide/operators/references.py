"""References between tables: does the parent row exist?

``NOT IN`` is never used. Spark runs it as a null-aware join that broadcasts the parent whatever
its size, and two of them joined by OR as nested loops. A flag per row serves the accepted and
the rejected rows at once, and comes from one of two joins:

- :func:`mark_known` joins with the parent keys. For parents that are small, so that Spark
  broadcasts them, and for child columns without hot values.
- :func:`mark_known_by_exceptions` looks up the values without a parent first. For large parents
  and for columns of which one value may hold a third of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealtide.operators.duplicates import MAX_BROADCAST_KEYS, is_small, key_size
from dealtide.operators.unions import union_all
from dealtide.session import store


def parent_keys(parent: DataFrame, column: str) -> DataFrame:
    """Distinct keys of a parent table, as the one column ``_parent_key``."""
    return (
        parent.select(F.col(column).alias("_parent_key"))
        .filter(F.col("_parent_key").isNotNull())
        .distinct()
    )


def mark_known(df: DataFrame, column: str, keys: DataFrame, flag: str) -> DataFrame:
    """Add a boolean column: is the value of ``column`` among ``keys``? NULL is not.

    ``keys`` are the result of :func:`parent_keys`, or any one column of distinct values.
    """
    keys = keys.select(F.col(keys.columns[0]).alias("_parent_key"), F.lit(True).alias("_found"))
    joined = df.join(keys, F.col(column) == F.col("_parent_key"), "left")
    return joined.select(*df.columns, F.col("_found").isNotNull().alias(flag))


class Lookup:
    """Which values of some columns have a parent? Looked up once, from the rows as they come in.

    ``references``: (column, keys of its parent, name of the flag). The values of all columns are
    counted in one pass over these columns, and those without a parent are stored with their size.
    :meth:`mark` then flags any rows with these columns, also after the rows were ranked or joined.

    If the values without a parent are few they are broadcast, and the rows stay where they are.
    Otherwise the rows are joined with the parent keys after all; these are stored before, because
    AQE splits hot partitions only if both sides come straight from a shuffle.
    """

    def __init__(
        self, df: DataFrame, references: Sequence[tuple[str, DataFrame, str]],
        max_keys: int = MAX_BROADCAST_KEYS,
    ):
        self._keys = {column: keys for column, keys, _ in references}
        self._flags = {column: flag for column, _, flag in references}
        known = union_all([
            keys.select(F.lit(column).alias("column_name"),
                        F.col(keys.columns[0]).cast("string").alias("value"), F.lit(True).alias("found"))
            for column, keys in self._keys.items()
        ])
        values = values_of(df, list(self._keys)).join(known, ["column_name", "value"], "left")
        lost = values.filter("found IS NULL").select("column_name", "value")
        sizes = [m for c in self._keys for m in key_size(["value"], f"{c}_", F.col("column_name") == c)]
        self._lost, self._measured = store(lost, *sizes)
        self._max_keys = max_keys

    def mark(self, df: DataFrame) -> DataFrame:
        """``df`` with all flags."""
        for column, flag in self._flags.items():
            df = self._mark(df, column, flag)
        return df

    def _mark(self, df: DataFrame, column: str, flag: str) -> DataFrame:
        if not self._measured[f"{column}_keys"]:
            return df.withColumn(flag, F.col(column).isNotNull())
        if not is_small(self._measured, self._max_keys, f"{column}_"):
            stored, _ = store(self._keys[column])
            return mark_known(df, column, stored, flag)
        lost = self._lost.filter(F.col("column_name") == column).select("value", F.lit(True).alias("_missing"))
        joined = df.join(F.broadcast(lost), F.col(column) == F.col("value"), "left")
        found = F.col(column).isNotNull() & F.col("_missing").isNull()
        return joined.select(*df.columns, found.alias(flag))


def values_of(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, rows) of several columns in one pass. NULL is no value.

    Combined before the shuffle, so that a hot value travels as one row of each task.
    """
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    listed = df.select(F.inline(F.array(*pairs))).filter(F.col("value").isNotNull())
    return listed.groupBy("column_name", "value").agg(F.count("*").alias("rows"))


def mark_known_by_exceptions(
    df: DataFrame, column: str, keys: DataFrame, flag: str, max_keys: int = MAX_BROADCAST_KEYS
) -> DataFrame:
    """As :func:`mark_known`, for a large parent that nearly all rows refer to: see :class:`Lookup`."""
    return Lookup(df, [(column, keys, flag)], max_keys).mark(df)


def rows_with(
    df: DataFrame, keys: DataFrame, columns: Sequence[str], max_keys: int = MAX_BROADCAST_KEYS
) -> DataFrame:
    """Rows of ``df`` whose ``columns`` are among ``keys``, a table with the same columns.

    The keys are stored, and broadcast if they are few.
    """
    keys, measured = store(keys.select(*columns), *key_size(columns))
    if is_small(measured, max_keys):
        keys = F.broadcast(keys)
    return df.join(keys, list(columns), "left_semi").select(*df.columns)


def unmatched(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Values of ``column`` without a parent, with their number of rows: ``(value, rows)``.

    The rows are counted per value before the join, so a hot value reaches it as one row.
    """
    keys = keys.select(F.col(keys.columns[0]).alias("value"))
    counts = (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("rows"))
    )
    return counts.join(keys, "value", "left_anti")
