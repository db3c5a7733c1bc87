"""What keeps the cost of large tables down, on small ones."""

from pathlib import Path

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from dealtide.catalog import queries
from dealtide.functions import dates, parse_ts
from dealtide.model import RAW_COLUMNS
from dealtide.plans.refresh import Cleaned, refresh
from dealtide.session import shared_folder


class Given(dict):
    """Tables in place of a feed."""

    def load_all(self):
        return self


@pytest.fixture
def given(spark, raw, tables, monkeypatch):
    """The queries read the fixture in place of the star schema."""
    monkeypatch.setattr(queries, "raw_feed", lambda *_: Given(raw))
    monkeypatch.setattr(queries, "main_feed", lambda *_: Given(tables))
    return Given(raw)


def test_entries_are_found_without_higher_order_functions(spark, raw):
    """Spark generates no code for these: each row of the table would be interpreted."""
    found = Cleaned(raw).entries("deal_products")
    assert "lambdafunction" not in plan_of(found) and found.count() > 0


def test_a_row_without_findings_has_an_empty_list(raw):
    annotated = Cleaned(raw).annotated("deals")
    assert annotated.filter("_found <> (size(_findings) > 0)").count() == 0
    assert annotated.filter("_found <> (_source_row IS NOT NULL) OR _found IS NULL").count() == 0
    assert {r[0] for r in annotated.select("_found").collect()} == {True, False}


@pytest.mark.parametrize("naive_tz", ["UTC", "+05:00"])
def test_usual_spellings_are_read_as_any_other(spark, naive_tz):
    texts = [
        "31.01.2024 10:20", " 31.01.2024", "2024/01/31 ", "", "  ", None, "31.02.2024", "2024/13/01", "31.01.2024 24:20",
        "31.01.2024\n", "2024/01/31\n", "01.01.0001", "29.02.2024 23:59", "2024-01-31", "2024-01-31T10:20:30+05:00",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")

    def instant(read):
        zoned = F.concat(read["local"].cast("string"), F.lit(" "), read["zone"])
        local = dates._in_zone(read["local"], naive_tz)
        return F.when(read["zone"] == "none", local).otherwise(zoned.try_cast("timestamp"))

    both = df.select("t", parse_ts(F.col("t"), naive_tz).cast("string").alias("a"),
                     dates._any_spelling(F.col("t"), instant).cast("string").alias("b"))
    assert [r for r in both.collect() if r.a != r.b] == []
    assert both.filter("a IS NOT NULL").count() >= 7


def test_ids_read_stored_entries(spark, given):
    """The ids of a journal read its entries several times: not the cleaning of all raw tables."""
    log = queries.QUERIES["journal_ids"](spark, "")
    assert ".csv" not in plan_of(log)
    assert rows(log.selectExpr("sum(entry_count) = sum(id_count)")) == [(True,)]


def test_stored_journals_leave_no_entries_behind(spark, given):
    folder = Path(shared_folder(spark)) / "dealtide-tables"
    before = {p.name for p in folder.glob("work-*")}
    defects = queries.QUERIES["sql_defects"](spark, "")
    assert ".csv" not in plan_of(defects)
    expected = sum(r.cnt for r in Cleaned(given).entries(*queries.JOURNALLED).groupBy("severity").agg(F.count("*").alias("cnt")).collect())
    assert sum(r.cnt for r in defects.collect()) >= expected
    assert {p.name for p in folder.glob("work-*")} == before


def test_views_of_defects_read_a_stored_journal(spark, given):
    totals = {r.view_name: r.row_count for r in queries.QUERIES["report_views"](spark, "").collect()}
    assert totals["v_data_quality_detail"] == Cleaned(given).entries(*queries.JOURNALLED).count()
    assert ".csv" not in plan_of(spark.table("v_data_quality_detail"))


def test_checked_tables_are_computed_once(spark, tables, monkeypatch):
    read = []
    checks = queries.expectations.quarantine
    monkeypatch.setattr(queries, "broken_feed", lambda *_: Given(tables))
    monkeypatch.setattr(queries.expectations, "quarantine", lambda df, *a: read.append(plan_of(df)) or checks(df, *a))
    found = queries.QUERIES["expect_quarantine"](spark, "")
    assert len(read) == len(tables) and all("dealtide-tables" in plan for plan in read)
    stay = {r.table_name: r.row_count for r in found.filter("rule_id = 'stays'").collect()}
    assert stay == {name: n for name in tables if (n := tables[name].count())}


def test_exports_are_compressed(spark, given):
    folder = Path(shared_folder(spark)) / "exports"
    before = set(folder.glob("*"))
    read = queries.QUERIES["scan_exports"](spark, "")
    [made] = set(folder.glob("*")) - before
    parts = list(made.glob("*.csv/part-*"))
    assert parts and all(p.name.endswith(".csv.gz") for p in parts)
    assert {r.table_name: r.n for r in read.groupBy("table_name").agg(F.count("*").alias("n")).collect()} == {
        t: n for t in RAW_COLUMNS if (n := given[t].count())}


def test_stored_tables_are_compressed_well(spark, raw, tmp_path):
    run = Path(refresh(spark, raw, str(tmp_path), run_id="one", constraints="quarantine"))
    parts = [*run.glob("raw/*/part-*.parquet"), *run.glob("main/*/**/part-*.parquet")]
    assert parts and all(p.name.endswith(".zstd.parquet") for p in parts)
