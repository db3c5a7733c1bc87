"""Shards that all hold the mixture of the sources: proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealtide.llm.ranking import running_sum
from dealtide.llm.tables import fraction, keep, plain_columns, shuffle_key, source_key

SEED = "shards"


def interleave(
    df: DataFrame, shards: int = 8, source: str = "source", identity: str = "doc_id", seed: str = SEED
) -> DataFrame:
    """All rows and columns, and ``shard`` (from 0) and ``slot`` (gapless from 0 in each shard).

    The rows of a source are shuffled and ranked; rank ``r`` of ``n`` stands at ``(r - 1/2) / n``.
    All rows are sorted by that fraction and cut into runs of equal length. So the rows of two
    shards differ by one at most, and so do, for each source, about, the rows that shards hold.

    A NULL source is a source. Rows are shuffled by ``identity``; rows that share it are put in
    the order of all their columns, and equal rows take neighbouring places. Columns of the names
    ``shard`` and ``slot`` are replaced. An empty table gives an empty table.
    """
    row = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in ("shard", "slot")]).alias("row"),
        source_key(F.col(f"`{source}`")).alias("source"),
        shuffle_key(seed, F.col(f"`{identity}`")).alias("key"),
        F.xxhash64(*plain_columns(df)).alias("tie"),
    )
    rows = df.count()
    one = F.lit(1).cast("long")
    ranked = running_sum(
        row, "source", fraction(F.col("key")), [F.col("key"), F.col("tie")], one, "rank", rows
    )
    sizes = row.groupBy(F.col("source").alias("of")).agg(F.count("*").alias("n"))
    placed = keep(
        ranked.join(sizes, F.col("source") == F.col("of")).select(
            "row", "source", "key", "tie",
            ((F.col("rank") * 2 - 1) / (F.col("n") * 2)).alias("place"),
        )
    )
    order = [F.col("place"), F.col("source"), F.col("key"), F.col("tie")]
    at = running_sum(placed, None, F.col("place"), order, one, "at", rows)
    return (
        at.withColumn("shard", F.expr(f"(at - 1) * {shards}L div {max(rows, 1)}L"))
        .withColumn("slot", F.expr(f"at - 1 - (shard * {max(rows, 1)}L + {shards - 1}L) div {shards}L"))
        .select("row.*", F.col("shard").cast("int").alias("shard"), "slot")
    )
