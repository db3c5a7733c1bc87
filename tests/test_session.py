from conftest import rows

from dealtide.operators.duplicates import mark_duplicates
from dealtide.session import SETTINGS, prepare, size_shuffles

PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def test_prepare_sets_a_running_session(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    prepare(spark)
    assert {name: spark.conf.get(name) for name in SETTINGS} == SETTINGS


def test_shuffles_are_sized_for_the_largest(spark):
    try:
        assert size_shuffles(spark, 10 * 1024**4) == 40_960
        assert size_shuffles(spark, 1) == int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert size_shuffles(spark, 4096, partition_bytes=100) == 41
        df = spark.range(1000).selectExpr("CAST(id % 400 AS STRING) AS k", "id")
        marked = mark_duplicates(df, ["k"], [], max_keys=0)
        assert rows(marked.groupBy("_duplicate").count()) == [(False, 400), (True, 600)]
    finally:
        spark.conf.unset(PARTITIONS)
