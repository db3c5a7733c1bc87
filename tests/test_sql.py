"""Table functions and text functions of Spark SQL against the Python reports and functions."""

import pytest
from conftest import AS_OF, plan_of, rows

from dealtide.functions import source_key, transliterate
from dealtide.plans import reports, sql

PERIOD = ("2025-03-01", "2025-03-08")
TIMES = f"timestamp'{PERIOD[0]}', timestamp'{PERIOD[1]}'"

CASES = {
    "funnel()": lambda t: reports.funnel(t),
    f"funnel({TIMES})": lambda t: reports.funnel(t, *PERIOD),
    f"funnel(to_time => timestamp'{PERIOD[1]}')": lambda t: reports.funnel(t, None, PERIOD[1]),
    "managers()": lambda t: reports.managers(t),
    f"managers({TIMES}, true)": lambda t: reports.managers(t, *PERIOD, won=True),
    "managers(won => true)": lambda t: reports.managers(t, won=True),
    "receivables()": lambda t: reports.receivables(t),
    "receivables(0.01)": lambda t: reports.receivables(t, min_remaining="0.01"),
    f"production_delays(date'{AS_OF}')": lambda t: reports.production_delays(t, AS_OF),
    f"production_delays(date'{AS_OF}', 0)": lambda t: reports.production_delays(t, AS_OF, days=0),
    f"stale_deals(date'{AS_OF}', days => 2)": lambda t: reports.stale_deals(t, AS_OF, days=2),
    "lead_sources()": lambda t: reports.lead_sources(t, with_romi=True),
    f"lead_sources({TIMES})": lambda t: reports.lead_sources(t, *PERIOD, with_romi=True),
    "defects()": lambda t: reports.defect_summary(t),
    "defects('error', 'run-1')": lambda t: reports.defect_summary(t, "error", "run-1"),
    "defects(of_run => 'another')": lambda t: reports.defect_summary(t, run_id="another"),
}


@pytest.fixture(scope="module")
def registered(spark, tables):
    assert sql.register(spark, tables) == sorted({c.split("(")[0] for c in CASES}, key=list(sql._functions({"deals": True, "marketing_costs": True})).index)
    return tables


@pytest.mark.parametrize("call", CASES)
def test_table_functions_give_the_reports(spark, registered, call):
    got, expected = spark.sql(f"SELECT * FROM {call}"), CASES[call](registered)
    assert got.dtypes == expected.dtypes
    assert rows(got) == rows(expected)


def test_arguments_become_filters_of_the_scan(spark, registered):
    plan = plan_of(spark.sql(f"SELECT * FROM managers({TIMES}, won => true)"))
    deals = [x for x in plan.splitlines() if "main/deals" in x]
    assert deals and all("PartitionFilters: [isnotnull(_month" in x and "GreaterThanOrEqual(created_at" in x for x in deals)
    assert not any(x in plan for x in ("Cartesian", "NestedLoop", "Python"))


def test_text_functions(spark):
    sql.register_text_functions(spark)
    given = [None, "", " ", "Сайт / Реклама", "щука-ёж", "a'b \\ c", "ÄÖ", "__x__", "ТЕЛЕФОН 2", "ъь"]
    df = spark.createDataFrame([(x,) for x in given], "x string")
    df.createOrReplaceTempView("spelled")
    got = spark.sql("SELECT x, source_key(x) AS k, translit(x) AS t FROM spelled")
    assert rows(got) == rows(df.select("x", source_key(df.x).alias("k"), transliterate(df.x).alias("t")))
