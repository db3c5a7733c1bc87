"""Connected components by alternating large and small stars, as joins and sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealtide.llm.tables import keep


def _lowest(edges: DataFrame, both_ways: bool) -> DataFrame:
    """One star step. Every node tells its neighbours (all of them that are larger, or all that are
    smaller, and itself) the smallest node it knows."""
    if both_ways:
        known = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = known.groupBy("a").agg(F.min("b").alias("least"))
        told = known.join(least, "a").filter(F.col("b") > F.col("a")).select(
            F.col("b").alias("a"), F.least("least", "a").alias("b")
        )
        return told.filter(F.col("a") != F.col("b")).distinct()
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    told = edges.join(least, "a")
    return (
        told.select(F.col("b").alias("a"), F.col("least").alias("b"))
        .unionByName(least.select("a", F.col("least").alias("b")))
        .filter(F.col("a") != F.col("b"))
        .distinct()
    )


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root: for each node of a link, the smallest node it is connected with.

    Each round is a few shuffles of the links, and leaves a forest that is less deep, until every
    node hangs on its root. No group is collected; hot nodes are summed up before the shuffle.
    """
    edges = keep(
        links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct()
    )
    seen = None
    while True:
        mark = edges.agg(
            F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))
        ).first()
        if mark == seen:
            break
        seen = mark
        edges = keep(_lowest(_lowest(edges, True), False))
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return keep(roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))
