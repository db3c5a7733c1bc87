"""Running sums over sorted rows without a task that sees a whole group.

A group may hold a third of all rows, and the whole table is a group too. A window would put it into
one task. So the rows of a group are dealt into ranges of about ``sqrt(all rows)`` rows each. The
sums of the ranges are added up first (as many rows as there are ranges), and a window within
each range does the rest. Ranges and rows in a range grow alike, as the square root of the input.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealtide.llm.tables import keep


def range_rows(rows: int) -> int:
    """Rows in a range, and number of ranges, for a table of so many rows."""
    return max(1, math.isqrt(max(rows, 1) - 1) + 1)


def running_sum(
    df: DataFrame,
    group: str | None,
    spread: Column,
    order: Sequence[Column],
    value: Column,
    name: str,
    rows: int,
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of ``group`` up to and including this one.

    ``spread``: from 0 to below 1, grows with ``order`` and is about evenly distributed in each
    group. ``rows``: of the table. ``df`` is read three times; store it if it is dear to compute.
    """
    columns = df.columns
    per_range = range_rows(rows)
    if group is None:
        dealt = df.withColumn("__group", F.lit("")).withColumn("__ranges", F.lit(per_range))
    else:
        # Stored, so that the join knows its size: a small one is broadcast, and no hot group is
        # shuffled for a join; a large one is joined by key, and AQE splits hot groups.
        sizes = keep(df.groupBy(F.col(group).alias("__group")).agg(
            F.ceil(F.count("*") / F.lit(per_range)).cast("int").alias("__ranges")
        ))
        dealt = df.withColumn("__group", F.col(group)).join(sizes, "__group")
    dealt = dealt.withColumn("__range", F.floor(spread * F.col("__ranges")).cast("int"))
    within = Window.partitionBy("__group").orderBy("__range")
    sums = dealt.groupBy("__group", "__range").agg(F.sum(value).alias("__sum")).select(
        "__group",
        "__range",
        (F.sum("__sum").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__sum"))
        .alias("__before"),
    )
    rest = Window.partitionBy("__group", "__range").orderBy(*order)
    return (
        dealt.join(sums, ["__group", "__range"])
        .withColumn(
            name,
            F.col("__before")
            + F.sum(value).over(rest.rowsBetween(Window.unboundedPreceding, 0)),
        )
        .select(*columns, name)
    )
