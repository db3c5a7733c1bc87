import random

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from dealtide.operators import duplicates
from dealtide.operators.duplicates import add_id, keep_first, mark_duplicates

SCHEMA = "k string, v int, t string"
# Route: (rows that make a key hot, keys that may be broadcast)
ROUTES = {
    "few repeated keys": (1000, 1000), "many repeated keys": (1000, 0),
    "hot keys": (5, 1000), "hot keys among many": (5, 0), "one hot key among many": (30, 2),
}


def table(seed):
    """A third of the rows are copies of one row, a few keys repeat, some are NULL."""
    r = random.Random(seed)
    data = [("hot", 7, "same")] * 60
    data += [(r.choice(["a", "b", "c", None, "hot"]), r.choice([1, 2, None]), r.choice("xyz"))
             for _ in range(60)]
    data += [(f"single {i}", i, "s") for i in range(60)]
    r.shuffle(data)
    return data


def first_of(data):
    """Brute force: the row to keep of every key, by v descending, NULL last, then all columns."""
    def order(row):
        k, v, t = row
        return (v is None, -(v or 0), k, (v is not None, v or 0), t)

    keys = {k for k, _, _ in data if k is not None}
    return {k: min((row for row in data if row[0] == k), key=order) for k in keys}


def prefer():
    return [F.col("v").desc_nulls_last()]


@pytest.mark.parametrize("hot_rows,max_keys", ROUTES.values(), ids=ROUTES.keys())
@pytest.mark.parametrize("partitions", [1, 7])
def test_one_row_of_every_key_stays(spark, hot_rows, max_keys, partitions):
    data = table(partitions)
    df = spark.createDataFrame(data, SCHEMA).repartition(partitions)
    marked = mark_duplicates(df, ["k"], prefer(), hot_rows=hot_rows, max_keys=max_keys)
    got = [tuple(r) for r in marked.collect()]
    assert sorted((g[:3] for g in got), key=str) == sorted(data, key=str)
    kept = sorted((g[:3] for g in got if not g[3] and g[0] is not None), key=str)
    assert kept == sorted(first_of(data).values(), key=str)
    assert all(not duplicate for k, _, _, duplicate in got if k is None)


def test_keep_first_agrees(spark):
    data = table(3)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    expected = list(first_of(data).values()) + [row for row in data if row[0] is None]
    assert rows(keep_first(df, ["k"], prefer())) == sorted(expected, key=str)


def test_keep_first_drops_rows_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).cast("string").alias("k"), "id")
    plan = plan_of(keep_first(df, ["k"], [F.col("id")]))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_a_table_without_repeated_keys_is_not_shuffled(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("k"))
    plan = plan_of(mark_duplicates(df, ["k"], []))
    assert "Exchange" not in plan and "Window" not in plan


def test_only_rows_of_repeated_keys_are_shuffled(spark):
    df = spark.range(100).select((F.col("id") % 90).cast("string").alias("k"), "id")
    marked = mark_duplicates(df, ["k"], [F.col("id")])
    assert marked.filter("_duplicate").count() == 10
    plan = plan_of(marked)
    assert "LeftSemi" in plan and "LeftAnti" in plan
    assert plan.count("BroadcastHashJoin") == 2


def test_two_column_keys(spark):
    data = [("a", 1, "x"), ("a", 1, "y"), ("a", 2, "x"), ("a", None, "x"), ("a", None, "x")]
    df = spark.createDataFrame(data, SCHEMA)
    marked = mark_duplicates(df, ["k", "v"], [F.col("t")])
    assert rows(marked.filter("_duplicate")) == [("a", 1, "y", True)]


@pytest.mark.parametrize("hot_rows,max_keys", ROUTES.values(), ids=ROUTES.keys())
def test_ids_are_distinct(spark, hot_rows, max_keys):
    df = spark.createDataFrame(table(1), SCHEMA).repartition(6)
    ids = add_id(df, "id", ["k", "v", "t"], hot_rows=hot_rows, max_keys=max_keys)
    assert ids.columns == ["id", "k", "v", "t"]
    assert ids.select("id").distinct().count() == 180
    assert rows(ids.drop("id")) == sorted(table(1), key=str)


def test_ids_do_not_depend_on_order_or_partitions(spark):
    data = table(2)
    one = spark.createDataFrame(data, SCHEMA).coalesce(1)
    many = spark.createDataFrame(sorted(data, key=str), SCHEMA).repartition(9)
    columns = ["k", "v", "t"]
    assert rows(add_id(one, "id", columns)) == rows(add_id(many, "id", columns))


@pytest.mark.parametrize("hot_rows,max_keys", ROUTES.values(), ids=ROUTES.keys())
def test_ids_are_the_same_on_every_route_and_for_any_partitions(spark, hot_rows, max_keys):
    data = table(4)
    columns = ["k", "v", "t"]
    plain = rows(add_id(spark.createDataFrame(data, SCHEMA), "id", columns))
    assert len({r[0] for r in plain}) == len(data) and all(len(r[0]) == 32 for r in plain)
    for partitions in (1, 4, 9):
        df = spark.createDataFrame(data, SCHEMA).repartition(partitions)
        assert rows(add_id(df, "id", columns, hot_rows=hot_rows, max_keys=max_keys)) == plain


def test_ids_of_some_columns_do_not_depend_on_partitions(spark):
    """Rows of a hot content that differ in the other columns."""
    data = [("hot", n % 7, f"t{n % 50}") for n in range(300)]
    df = spark.createDataFrame(data, SCHEMA)
    plain = rows(add_id(df, "id", ["k"]))
    assert len({r[0] for r in plain}) == 300
    for partitions in (1, 4, 9):
        hot = rows(add_id(df.repartition(partitions), "id", ["k"], hot_rows=20))
        assert {r[0] for r in hot} == {r[0] for r in plain}
        assert hot == rows(add_id(df.coalesce(1), "id", ["k"], hot_rows=20))


def test_hot_rows_of_one_task_are_spread(spark):
    data = [("hot", n, "different") for n in range(10_000)] + [("hot", -1, "same")] * 5_000
    df = spark.createDataFrame(data, SCHEMA).coalesce(1)
    spread = duplicates._Repeated(df, ["k"], 100, 1000).spread()
    assert spread.filter("t = 'same'").count() == 1
    assert spread.groupBy("k", "_salt").count().agg(F.max("count")).first()[0] <= 200


def test_many_copies_are_made_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(duplicates, "COPIES_AT_ONCE", 10)
    counted = spark.createDataFrame([("a", 95), ("b", 1)], "k string, _copies bigint")
    copies = duplicates._with_copies(counted, 10)
    assert rows(copies) == sorted([("a", n) for n in range(1, 96)] + [("b", 1)], key=str)


@pytest.mark.parametrize("hot_rows", [1000, 5])
def test_rows_without_a_repeated_key_pass_through(spark, hot_rows):
    df = spark.createDataFrame(table(6), SCHEMA)
    plan = plan_of(mark_duplicates(df, ["k"], prefer(), hot_rows=hot_rows))
    lines = plan.splitlines()
    union = next(n for n, line in enumerate(lines) if "Union" in line)
    assert not any(w in line for line in lines[:union] for w in ("Window", "Exchange"))
    anti = next(n for n, line in enumerate(lines) if "LeftAnti" in line)
    others = lines[anti:]
    assert not any("Exchange hashpartitioning" in line for line in others)
