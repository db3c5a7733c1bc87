"""The corpus pipeline: toxic texts out, near duplicates out, benchmark passages out, mix, shards.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept. ``run``
writes what a stage returns as Parquet into the folder that all executors share, and reads it again
for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealtide.llm import decontaminate, mixing, neardup, sharding, toxicity
from dealtide.llm.tables import keep, read, words_in

#: Score from which a text is toxic.
TOXIC = 0.7
#: Words of a shingle for near duplicates.
SHINGLE = 5
#: Weights of the sources in the order of their names, repeated, and the share of all words to take.
#: No document is taken twice: that would bring back the copies that an earlier stage took out.
WEIGHTS, SHARE, REPEATS = (5, 2, 1), 0.9, 1
SHARDS = 8


def _columns(docs: DataFrame) -> list[str]:
    return [f"`{c}`" for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts below the toxic score. A NULL or empty text stays; labels are those of the table."""
    lexicon = toxicity.learn_from_tables(docs, read(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select(F.struct(*_columns(docs)).alias("row"), F.col("text")), lexicon)
    return scored.filter(F.col("toxicity.score") < TOXIC).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One text of each group of near duplicates, the one with the smallest id. Texts without words
    all stay."""
    rest = [c for c in _columns(docs) if c.lower() not in ("`doc_id`", "`text`")]
    packed = docs.select("doc_id", "text", F.struct(F.lit(0), *rest).alias("rest"))  # the text once
    kept = neardup.near_duplicates(packed, size=SHINGLE).filter("representative")
    return kept.select("doc_id", "text", "rest.*").select(*_columns(docs))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that hold no passage of the benchmark, exactly or with a few edits."""
    packed = docs.select(F.struct(*_columns(docs)).alias("row"), "text")
    found = decontaminate.find_leaks(packed, read(spark, sf_dir, "benchmark"))
    return found.filter(F.size("leaks") == 0).select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the mix takes: by weight, up to the share of all words. Texts without words take
    nothing from the budget and stay."""
    packed = docs.select(
        F.struct(*_columns(docs)).alias("row"), "doc_id", "source", words_in(F.col("text")).alias("words")
    )
    mixed = mixing.mix(packed, "words", WEIGHTS, SHARE, REPEATS)
    return mixed.filter((F.col("copies") > 0) | (F.col("words") == 0)).select("row.*")


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All texts with their shard and slot; every shard holds the mixture of the sources."""
    return sharding.interleave(docs, SHARDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("sharding", deal_shards),
]

#: The first three stages are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents, one after the other."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
