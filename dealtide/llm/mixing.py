"""Mixing sources to target weights: weighted fair queueing of shuffled documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealtide.llm.ranking import range_rows, running_sum
from dealtide.llm.tables import fraction, keep, plain_columns, shuffle_key, source_key

SEED = "mixture"


def targets(
    sizes: DataFrame, weights: Sequence[int] | Mapping[str | None, float], share: float, repeats: int
) -> DataFrame:
    """Words to take from each source. ``sizes``: source, source_size. Adds ``target``.

    The budget is ``share`` times all sizes. It is dealt by weight; no source gets more than
    ``repeats`` times its size, and what it would have got above that is dealt again among the
    others. Sorted by size over weight, the sources that are full come first, so one running sum
    finds the level at which the others stand. ``weights`` is repeated over the sources by code
    point, NULL last, or given by source (1 if missing). One row a source, so the window is small.
    """
    everything = Window.partitionBy(F.lit(0))
    place = F.row_number().over(everything.orderBy("source"))
    if isinstance(weights, Mapping):
        weight = F.lit(1.0)
        for name, given in weights.items():
            weight = F.when(F.col("source") == source_key(F.lit(name)), float(given)).otherwise(weight)
    else:
        listed = F.array(*[F.lit(float(w)) for w in weights])
        weight = F.element_at(listed, (place - 1) % len(weights) + 1)
    by_fill = everything.orderBy((F.col("most") / F.col("weight")), "source")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0.0)
    levels = (
        sizes.withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * F.lit(float(repeats)))
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("fill", F.row_number().over(by_fill))
        .withColumn("left", F.col("budget") - F.coalesce(F.sum("most").over(before), none))
        .withColumn(
            "sharing",
            F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), none),
        )
        .withColumn("level", F.col("left") / F.col("sharing"))
        .withColumn(
            "first",
            F.min(
                F.when(F.col("level") <= F.col("most") / F.col("weight"), F.struct("fill", "level"))
            ).over(everything),
        )
    )
    shared = F.least(F.col("most"), F.col("first.level") * F.col("weight"))
    target = F.when(F.col("fill") >= F.col("first.fill"), shared).otherwise(F.col("most"))
    return levels.select(*sizes.columns, "budget", target.alias("target"))


def mix(
    df: DataFrame,
    size: str,
    weights: Sequence[int] | Mapping[str | None, float] = (5, 2, 1),
    share: float = 1.5,
    repeats: int = 2,
    source: str = "source",
    identity: str = "doc_id",
    seed: str = SEED,
) -> DataFrame:
    """All rows and columns, with ``source_size``, ``target``, ``copies`` and ``finish``.

    Each source serves its shuffled documents, up to ``repeats`` times one after the other. A copy
    finishes at the words served so far by its source over the source's target. Copies are put in
    the order of their finish, across all sources, until the budget is used up: ``copies`` says how
    often the document was taken (whole documents), ``finish`` when its first copy finishes.

    The finish is cut into ranges. The sums of the ranges tell in which one the budget ends, and only
    that range is sorted by row. What comes of it is one sort key, the first that is not taken.

    A NULL source is a source, the last. NULL or 0 in ``size`` counts 0 and is never taken. Rows that
    share ``identity`` are put in the order of all their columns. Columns of the names added are
    replaced. An empty table gives an empty table.
    """
    added = ("source_size", "target", "copies", "finish")
    row = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in added]).alias("row"),
        source_key(F.col(f"`{source}`")).alias("source"),
        F.greatest(F.coalesce(F.col(f"`{size}`").cast("long"), F.lit(0)), F.lit(0)).alias("size"),
        shuffle_key(seed, F.col(f"`{identity}`")).alias("key"),
        F.xxhash64(*plain_columns(df)).alias("tie"),
    )
    rows = df.count()
    served = running_sum(
        row, "source", fraction(F.col("key")), [F.col("key"), F.col("tie")], F.col("size"), "served", rows
    )
    sizes = row.groupBy("source").agg(F.sum("size").alias("source_size"))
    wanted = keep(targets(sizes, weights, share, repeats))
    queue = served.join(wanted, "source")
    # What the cut is found on is stored without the rows; these are shuffled once, for the result.
    line = keep(queue.select("source", "size", "key", "source_size", "target", "served"))
    budget = wanted.agg(F.max("budget")).first()[0] or 0.0

    def finish(turn):
        served = turn * F.col("source_size") + F.col("served")
        return served / F.nullif(F.col("target"), F.lit(0.0))

    ranges = range_rows(rows)
    # Up to 1 all sources still serve; what finishes later, however late, gets as many ranges.
    late = F.least(F.floor((1 - 1 / F.col("finish")) * ranges), F.lit(ranges - 1)) + ranges
    copies = (
        line.filter((F.col("size") > 0) & (F.col("target") > 0))
        .select("source", "size", "key", "served", "source_size", "target",
                F.explode(F.array(*[F.lit(t) for t in range(repeats)])).alias("turn"))
        .withColumn("finish", finish(F.col("turn")))
        .withColumn("range", F.when(F.col("finish") < 1, F.floor(F.col("finish") * ranges)).otherwise(late))
    )
    upto = Window.partitionBy(F.lit(0)).orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    ends = (
        copies.groupBy("range").agg(F.sum("size").alias("size"))
        .withColumn("upto", F.sum("size").over(upto))
        .filter(F.col("upto") > budget).orderBy("range").limit(1).collect()
    )
    order = ["finish", "source", "key", "served", "turn"]
    beyond = None
    if ends:
        before = ends[0]["upto"] - ends[0]["size"]
        by_finish = Window.partitionBy(F.lit(0)).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        beyond = (
            copies.filter(F.col("range") == ends[0]["range"])
            .withColumn("upto", F.sum("size").over(by_finish) + F.lit(before))
            .filter(F.col("upto") > budget).orderBy(*order).limit(1).select(*order).collect()[0]
        )
    taken, kind = F.lit(0), "struct<a:double,b:string,c:string,d:bigint,e:int>"
    for turn in range(repeats):
        key = F.struct(finish(F.lit(turn)), "source", "key", "served", F.lit(turn)).cast(kind)
        fits = F.lit(True) if beyond is None else key < F.struct(*[F.lit(v) for v in beyond]).cast(kind)
        taken = taken + fits.cast("int")
    possible = (F.col("size") > 0) & (F.col("target") > 0)
    return queue.select(
        "row.*",
        "source_size",
        "target",
        F.when(possible, taken).otherwise(0).alias("copies"),
        F.when(possible, finish(F.lit(0))).alias("finish"),
    )
