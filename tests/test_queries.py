"""The registered queries against their SQL in DuckDB, and the shape of their plans."""

import os
import re

import pytest
from conftest import plan_of

import __spark_entry__ as entry_point
from dealtide.catalog.feed import BASE_TABLES
from dealtide.catalog.oracle import ORACLE
from dealtide.catalog.queries import QUERIES
from dealtide.plans import reports

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for table in BASE_TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLE) <= set(entry_point.oracle_sql())


def canonical(row):
    return tuple(repr(v) for v in row)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_result_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted(canonical(r) for r in df.select(*columns).collect())
    result = duck.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    expected = sorted(canonical(r[i] for i in places) for r in result.fetchall())
    assert got == expected

    plan = plan_of(df)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|EvalPython|InPandas", plan)


def test_filters_reach_the_scan(tables):
    plan = plan_of(reports.funnel(tables, "2025-03-03", "2025-03-05"))
    deals = next(line for line in plan.splitlines() if "main/deals" in line)
    pushed = deals[deals.index("PushedFilters"):]
    assert "GreaterThanOrEqual(created_at" in pushed and "LessThan(created_at" in pushed
    assert "title" not in deals


def test_only_needed_columns_are_read(spark):
    lines = next(line for line in plan_of(QUERIES["report_managers"](spark, SF_DIR)).splitlines()
                 if "lineitem.parquet" in line)
    assert "l_tax" not in lines and "l_shipdate" not in lines


def test_lines_are_summed_before_the_join_with_deals(spark):
    plan = plan_of(QUERIES["report_managers"](spark, SF_DIR))
    assert "partial_sum" in plan


def test_entry(spark):
    assert entry_point.entry(spark).count() == 25
