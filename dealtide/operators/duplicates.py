"""Duplicate rows and generated ids, for tables of any size and keys of any frequency.

Most keys have one row. So the keys with several rows are looked up first: one pass over the key
columns, combined before the shuffle, whose result is stored with its size.

- If there are few of them, they are broadcast, and only their rows are shuffled and ranked. The
  rest of the table passes through without a shuffle.
- If there are many, the whole table is ranked, but for rows without a key.
- Either way a single key may hold a third of the table. Equal rows of a key are interchangeable:
  they are counted before the shuffle and travel as one row. The different rows of a hot key are
  dealt out by a hash of their content, wherever they were read, and ranked in parts; the parts
  are joined by their sums. So the result is the same for any partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealtide.session import store

#: Rows of one key that a single task may rank.
HOT_ROWS = 1_000_000
#: Keys are broadcast up to this number and this total length.
MAX_BROADCAST_KEYS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
#: Copies of one row that a task makes at once when counted rows become rows again.
COPIES_AT_ONCE = 10_000


def key_size(key: Sequence[str], prefix: str = "", where: Column | None = None) -> list[Column]:
    """Measures for :func:`dealtide.session.store`: number and total length of keys."""
    where = F.lit(True) if where is None else where
    length = F.octet_length(F.concat_ws("", *[F.col(c).cast("string") for c in key]))
    return [
        F.count_if(where).alias(f"{prefix}keys"),
        F.coalesce(F.sum(F.when(where, length)), F.lit(0)).alias(f"{prefix}bytes"),
    ]


def is_small(measured: dict, max_keys: int = MAX_BROADCAST_KEYS, prefix: str = "") -> bool:
    few = measured[f"{prefix}keys"] <= max_keys
    return few and measured[f"{prefix}bytes"] <= MAX_BROADCAST_BYTES


def _known(key: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])


class _Repeated:
    """The keys with several rows: ``rows`` of them, the ``others``, and the ``hot`` keys."""

    def __init__(self, df: DataFrame, key: Sequence[str], hot_rows: int, max_keys: int):
        self.key = list(key)
        keys, measured = store(
            df.filter(_known(key)).groupBy(*key).agg(F.count("*").alias("_rows")).filter("_rows > 1"),
            *key_size(key),
            *key_size(key, "hot_", F.col("_rows") > hot_rows),
        )
        self.any = bool(measured["keys"])
        if is_small(measured, max_keys):
            few = F.broadcast(keys.select(*key))
            self.rows = df.join(few, self.key, "left_semi").select(*df.columns)
            self.others = df.join(few, self.key, "left_anti").select(*df.columns)
        else:
            self.rows, self.others = df.filter(_known(key)), df.filter(~_known(key))
        self.hot = None
        if measured["hot_keys"]:
            self._small_hot = is_small(measured, max_keys, "hot_")
            self.hot = self.small(keys.filter(F.col("_rows") > hot_rows).select(
                *key, F.ceil(F.col("_rows") / hot_rows).cast("int").alias("_salts")
            ))

    def small(self, per_hot_key: DataFrame) -> DataFrame:
        """Broadcast a table with a row for each hot key, if these are few."""
        return F.broadcast(per_hot_key) if self._small_hot else per_hot_key

    def spread(self) -> DataFrame:
        """The different rows with ``_copies``, and ``_salt``, which is 0 but for hot keys."""
        columns = self.rows.columns
        different = self.rows.groupBy(*columns).agg(F.count("*").alias("_copies"))
        salt = F.pmod(F.xxhash64(*columns, F.lit("salt")), F.col("_salts")).cast("int")
        salted = different.join(self.hot, self.key, "left")
        return salted.select(*columns, "_copies", F.coalesce(salt, F.lit(0)).alias("_salt"))


def _with_copies(df: DataFrame, at_once: int = COPIES_AT_ONCE) -> DataFrame:
    """Each row as often as its ``_copies`` say, with the number of the copy as ``_copy``.

    Many copies of one row are made by many tasks.
    """
    rest = [c for c in df.columns if c != "_copies"]
    most = F.expr(f"(_copies - 1) div {at_once}L")
    parts = df.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), most)))
    made = F.least(F.col("_copies") - F.col("_part") * at_once, F.lit(at_once))
    return (
        parts.repartition("_part", *rest)
        .withColumn("_number", F.explode(F.sequence(F.lit(1).cast("long"), made)))
        .withColumn("_copy", F.col("_part") * at_once + F.col("_number"))
        .select(*rest, "_copy")
    )


def mark_duplicates(
    df: DataFrame,
    key: Sequence[str],
    prefer: Sequence[Column],
    flag: str = "_duplicate",
    hot_rows: int = HOT_ROWS,
    max_keys: int = MAX_BROADCAST_KEYS,
) -> DataFrame:
    """Flag all rows of a key but one. The row that sorts first by ``prefer`` is not flagged.

    All columns break the remaining ties, so the choice does not depend on the order of the
    input. Rows with a NULL in the key are never duplicates of each other.
    """
    key = list(key)
    order = [*prefer, *[F.col(c) for c in df.columns]]
    repeated = _Repeated(df, key, hot_rows, max_keys)
    if not repeated.any:
        return df.withColumn(flag, F.lit(False))
    others = repeated.others.withColumn(flag, F.lit(False))
    place = F.row_number()
    if repeated.hot is None:
        ranked = repeated.rows.withColumn("_place", place.over(Window.partitionBy(*key).orderBy(*order)))
        marked = ranked.select(*df.columns, (F.col("_place") > 1).alias(flag))
        return marked.unionByName(others)
    in_part = Window.partitionBy(*key, "_salt").orderBy(*order)
    ranked, _ = store(repeated.spread().withColumn("_place", place.over(in_part)))
    # Only the first rows of the parts of hot keys meet.
    firsts = ranked.filter("_place = 1").join(repeated.hot, key, "left_semi")
    best = firsts.withColumn("_first", place.over(Window.partitionBy(*key).orderBy(*order)))
    best = best.filter("_first = 1").select(*key, F.col("_salt").alias("_best"))
    stays = (F.col("_place") == 1) & (F.col("_salt") == F.coalesce("_best", "_salt"))
    chosen = ranked.join(repeated.small(best), key, "left").withColumn("_stays", stays)
    copies = _with_copies(chosen.select(*df.columns, "_copies", "_stays"))
    duplicate = ~(F.col("_stays") & (F.col("_copy") == 1))
    return copies.select(*df.columns, duplicate.alias(flag)).unionByName(others)


def keep_first(df: DataFrame, key: Sequence[str], prefer: Sequence[Column]) -> DataFrame:
    """Only the rows that :func:`mark_duplicates` would not flag, as one plan.

    ``rank = 1`` lets Spark drop the other rows of a key before the shuffle as well, so that hot
    keys need no salt here. But all that remains is shuffled.
    """
    order = [*prefer, *[F.col(c) for c in df.columns]]
    first = (
        df.filter(_known(key))
        .withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )
    if not any(df.schema[c].nullable for c in key):
        return first
    return first.unionByName(df.filter(~_known(key)))


def add_id(
    df: DataFrame,
    name: str,
    columns: Sequence[str],
    hot_rows: int = HOT_ROWS,
    max_keys: int = MAX_BROADCAST_KEYS,
) -> DataFrame:
    """Add an id of 128 bits, as hex digits, made from the content of a row and its ordinal among
    the rows with that content.

    The same rows get the same ids in every run, with any partitioning, and whether or not a
    content is hot. Other columns of the row only put the rows of one content in order.
    """
    content = F.sha2(F.to_json(F.struct(*columns)), 256)
    hashed = df.withColumn("_content", content)
    made = F.substring(F.sha2(F.concat_ws("#", "_content", F.col("_ordinal").cast("string")), 256), 1, 32).alias(name)
    order = [F.col(c) for c in df.columns]
    repeated = _Repeated(hashed, ["_content"], hot_rows, max_keys)
    one = F.lit(1).cast("long")
    if not repeated.any:
        return hashed.withColumn("_ordinal", one).select(made, *df.columns)
    if repeated.hot is None:
        within = Window.partitionBy("_content").orderBy(*order)
        numbered = repeated.rows.withColumn("_ordinal", F.row_number().over(within).cast("long"))
    else:
        in_part = Window.partitionBy("_content", "_salt").orderBy(*order)
        so_far = in_part.rowsBetween(Window.unboundedPreceding, 0)
        ranked, _ = store(repeated.spread().withColumn("_upto", F.sum("_copies").over(so_far)))
        parts = ranked.groupBy("_content", "_salt").agg(F.sum("_copies").alias("_sum"))
        before = Window.partitionBy("_content").orderBy("_salt")
        offsets = parts.withColumn(
            "_before", F.sum("_sum").over(before.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_sum")
        ).drop("_sum")
        first = F.col("_before") + F.col("_upto") - F.col("_copies")
        placed = ranked.join(offsets, ["_content", "_salt"]).withColumn("_first", first)
        copies = _with_copies(placed.select(*hashed.columns, "_copies", "_first"))
        numbered = copies.withColumn("_ordinal", F.col("_first") + F.col("_copy"))
    alone = repeated.others.withColumn("_ordinal", one)
    return numbered.select(*alone.columns).unionByName(alone).select(made, *df.columns)
