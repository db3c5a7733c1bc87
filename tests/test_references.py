import re

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from dealtide.operators.references import (
    mark_known, mark_known_by_exceptions, parent_keys, unmatched,
)
from dealtide.plans.reports import deal_economics

CHILDREN = [("1", "a"), ("2", "a"), ("3", "x"), ("4", None), ("5", "x"), ("6", "b"), ("7", "")]
PARENTS = [("a",), ("a",), ("b",), (None,), ("c",)]
EXPECTED = sorted([("1", "a", True), ("2", "a", True), ("3", "x", False), ("4", None, False),
                   ("5", "x", False), ("6", "b", True), ("7", "", False)], key=str)


@pytest.fixture
def children(spark):
    return spark.createDataFrame(CHILDREN, "id string, p string")


@pytest.fixture
def keys(spark):
    return parent_keys(spark.createDataFrame(PARENTS, "p string"), "p")


def test_known_parents(children, keys):
    assert rows(mark_known(children, "p", keys, "ok")) == EXPECTED


@pytest.mark.parametrize("max_keys", [100, 0])
def test_known_parents_by_exceptions(children, keys, max_keys):
    marked = mark_known_by_exceptions(children, "p", keys, "ok", max_keys=max_keys)
    assert rows(marked) == EXPECTED


def test_nothing_is_joined_if_no_parent_is_missing(spark, keys):
    df = spark.createDataFrame([("1", "a"), ("2", None)], "id string, p string")
    marked = mark_known_by_exceptions(df, "p", keys, "ok")
    assert "Join" not in plan_of(marked)
    assert rows(marked) == [("1", "a", True), ("2", None, False)]


def test_unmatched_counts_rows(children, keys):
    assert rows(unmatched(children, "p", keys)) == [("", 1), ("x", 2)]


SKEWED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def no_broadcasts(spark):
    before = {name: spark.conf.get(name) for name in SKEWED}
    for name, value in SKEWED.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def hot_rows(spark, path, column):
    """300,000 rows, of which a third name parent 5."""
    number = F.col("id")
    spark.range(0, 300_000, 1, 12).select(
        F.when(number % 3 == 0, F.lit(5)).otherwise(number).cast("string").alias(column),
        F.sha2(number.cast("string"), 512).alias("payload"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_a_hot_reference_is_split_at_run_time(spark, tmp_path, no_broadcasts):
    child = hot_rows(spark, str(tmp_path / "child"), "p")
    parent = spark.range(0, 300_000, 2).select(F.col("id").cast("string").alias("p"))
    marked = mark_known_by_exceptions(child, "p", parent_keys(parent, "p"), "ok", max_keys=0)
    got = [r.ok for r in marked.select("payload", "ok").collect()]
    # Parent 5 does not exist; of the other parents every second one does.
    assert (got.count(True), got.count(False)) == (100_000, 200_000)
    frame = marked.select("payload", "ok")
    frame.collect()
    assert re.search(r"SortMergeJoin\(skew=true\)", plan_of(frame))


def test_a_hot_product_is_split_at_run_time(spark, tmp_path, no_broadcasts):
    lines = hot_rows(spark, str(tmp_path / "lines"), "product_id").select(
        "product_id", F.substring("payload", 1, 40).alias("deal_id"),
        F.lit(1).cast("smallint").alias("quantity"),
        F.lit(3).cast("decimal(14,2)").alias("unit_price"),
        F.lit(0).cast("decimal(14,2)").alias("discount"),
    )
    products = str(tmp_path / "products")
    spark.range(300_000).select(
        F.col("id").cast("string").alias("product_id"),
        F.lit(1).cast("decimal(14,2)").alias("cost_price"),
    ).write.parquet(products)
    economics = deal_economics(
        {"deal_products": lines, "products": spark.read.parquet(products)}
    )
    total = economics.agg(F.count("*").alias("n"), F.sum("margin").alias("margin"))
    assert tuple(total.collect()[0]) == (300_000, 600_000)
    assert re.search(r"SortMergeJoin\(skew=true\)", plan_of(total))
