import datetime
import json

import pytest
from conftest import DATA, rows
from pyspark.sql import functions as F

from dealtide.model import RAW_COLUMNS, TABLES
from dealtide.operators.expectations import ConstraintError
from dealtide.operators.findings import EXTRA_RULES
from dealtide.plans import cleaning
from dealtide.plans.cleaning import Options
from dealtide.plans.refresh import Cleaned, refresh
from dealtide.sources.snapshot import read_snapshot

JOURNAL = [
    ("error", "activities", "V4", "DEAL_MISSING"),
    ("error", "deal_products", "A-2/G9", "REFERENCE_MISSING"),
    ("error", "deal_products", "A-4/G3", "REFERENCE_MISSING"),
    ("error", "deal_products", "A-99/G1", "REFERENCE_MISSING"),
    ("error", "deal_products", None, "FK_NULL"),
    ("error", "payments", "Y4", "DEAL_MISSING"),
    ("error", "payments", "Y6", "FK_NULL"),
    ("error", "production_orders", "W4", "DEAL_MISSING"),
    ("error", "shipments", "S2", "SHIPMENT_DEAL_MISSING"),
    ("error", "stage_history", "E3", "DEAL_MISSING"),
    ("error", "stage_history", "E3", "DEAL_MISSING"),
    ("warning", "companies", "K3", "NAME_BLANK"),
    ("warning", "companies", "K4", "NAME_BLANK"),
    ("warning", "contacts", "H2", "COMPANY_UNKNOWN"),
    ("warning", "deals", "A-10", "TS_UNPARSED"),
    ("warning", "deals", "A-2", "DEAL_DUPLICATE"),
    ("warning", "deals", "A-4", "WON_NOT_CLOSED"),
    ("warning", "deals", "A-5", "STAGE_UNKNOWN"),
    ("warning", "deals", "A-6", "AMOUNT_NEGATIVE"),
    ("warning", "deals", "A-9", "DEAL_DUPLICATE"),
    ("warning", "payments", "Y7", "TS_UNPARSED"),
    ("warning", "products", "G3", "SKU_DUPLICATE"),
    ("warning", "products", "G4", "SKU_DUPLICATE"),
    ("warning", "products", "G6", "SKU_NULL"),
    ("warning", "products", "G7", "SKU_NULL"),
    ("warning", "stage_history", "E2", "EVENT_DUPLICATE"),
    ("warning", "stage_history", "E3", "EVENT_DUPLICATE"),
]


def test_journal(tables):
    got = rows(tables["rejects"], "severity", "source_table", "record_key", "rule_id")
    assert got == sorted(JOURNAL, key=str)


def test_journal_holds_the_source_row(tables):
    entry = tables["rejects"].filter("record_key = 'K4'").first()
    assert json.loads(entry.raw_data) == {
        "company_id": "K4", "name": "", "inn": None, "city": "Turku", "industry": None,
        "created_at": None,
    }
    assert entry.run_id == "run-1" and entry.reason == "company without a name"
    lost = tables["rejects"].filter("record_key = 'A-99/G1'").first()
    assert json.loads(lost.raw_data)["quantity"] == "not a number"


def test_extra_rules_can_be_left_out(spark, raw):
    found = Cleaned(raw).entries("products", "payments", "deals", "shipments", extra=False)
    expected = [j for j in JOURNAL if j[3] not in EXTRA_RULES
                and j[1] in ("products", "payments", "deals", "shipments")]
    assert rows(found, "severity", "source_table", "record_key", "rule_id") == sorted(
        expected, key=str)


COUNTS = {
    "sources": 4, "users": 4, "pipeline_stages": 10, "companies": 4, "products": 5, "contacts": 3,
    "deals": 11, "deal_products": 4, "payments": 5, "activities": 4, "stage_history": 8,
    "production_orders": 4, "shipments": 2, "marketing_costs": 4, "rejects": 27,
}


def test_row_counts(tables):
    assert {name: df.count() for name, df in tables.items()} == COUNTS


def test_tables_have_the_declared_types(tables):
    for name, spec in TABLES.items():
        assert [(f.name, f.dataType) for f in tables[name].schema] == [
            (f.name, f.dataType) for f in spec.schema]


def test_every_raw_row_is_accepted_or_journalled_as_dropped(spark, raw):
    cleaned = Cleaned(raw)
    for table in RAW_COLUMNS:
        annotated = cleaned.annotated(table)
        dropped = annotated.filter("_dropped")
        assert annotated.count() == raw[table].count()
        assert dropped.filter(F.size("_findings") == 0).count() == 0


def test_sources(tables):
    assert rows(tables["sources"]) == [
        ("fair", "Fair"), ("radio", "Radio"), ("web_site", "Web Site"), ("yarmarka", "Yarmarka")]


def test_deals(tables):
    got = {r.deal_id: r for r in tables["deals"].collect()}
    assert got["A-2"].title == "Newest" and str(got["A-2"].expected_amount) == "2500.50"
    assert got["A-9"].title == "a"
    assert got["A-5"].stage_id == got["A-6"].stage_id == got["A-8"].stage_id == "UNKNOWN"
    assert got["A-6"].expected_amount is None and got["A-8"].expected_amount is None
    assert got["A-7"].created_at == datetime.datetime(2025, 4, 5, 8, 30)
    assert got["A-7"].currency is None and got["A-7"].source_id is None
    assert got["A-10"].updated_at is None
    assert got["A-11"].title == 'Lost,\n"at sea"'
    assert got["A-3"].source_id == got["A-4"].source_id == "web_site"
    assert got["A-1"].custom_deadline == datetime.date(2025, 3, 20)
    assert got["A-1"].created_at == datetime.datetime(2025, 3, 1, 7, 0)


def test_products_prefer_the_ones_in_use(tables):
    # G1 and G3 are both in use: the smaller id stays. Of G4 and G5 only G5 is in use.
    assert rows(tables["products"], "product_id", "cost_price")[0][0] == "G1"
    assert {r.product_id for r in tables["products"].collect()} == {"G1", "G2", "G5", "G6", "G7"}
    costs = {r.product_id: str(r.cost_price) for r in tables["products"].collect()}
    assert costs["G2"] == "20.01"


def test_contacts(tables):
    assert rows(tables["contacts"], "contact_id", "company_id") == [
        ("H1", "K1"), ("H2", None), ("H3", None)]


def test_payments(tables):
    got = {r.payment_id: (r.payment_date, str(r.amount)) for r in tables["payments"].collect()}
    assert got == {
        "Y1": (datetime.date(2025, 3, 5), "100.00"),
        "Y2": (datetime.date(2025, 3, 6), "50.00"),
        "Y3": (datetime.date(2025, 3, 8), "4500.00"),  # 02:30 UTC on the next day
        "Y5": (datetime.date(2025, 3, 12), "-20.00"),
        "Y7": (None, "15.00"),
    }


def test_stage_history(tables):
    assert rows(tables["stage_history"], "event_id", "old_stage_id", "new_stage_id") == [
        ("E1", None, "NEW"), ("E2", "NEW", "PRODUCTION"), ("E4", "UNKNOWN", "QUALIFICATION"),
        ("E5", "QUALIFICATION", "UNKNOWN"), ("E6", None, "NEW"), ("E7", "WON", "LOST"),
        ("E8", "PROPOSAL", "CONTRACT"), ("E9", "CONTRACT", "PROPOSAL"),
    ]


def test_generated_ids_are_distinct_and_stable(spark, raw, tables):
    again = Cleaned({**raw, "marketing_costs": raw["marketing_costs"].repartition(3)})
    assert tables["marketing_costs"].select("cost_id").distinct().count() == 4
    assert rows(again["marketing_costs"]) == rows(tables["marketing_costs"])
    assert tables["rejects"].select("reject_id").distinct().count() == 27


def test_result_does_not_depend_on_order_or_partitions(spark, raw, tables):
    shuffled = {t: df.repartition(5).sortWithinPartitions(F.rand(3)) for t, df in raw.items()}
    again = Cleaned(shuffled)
    for table in ("deals", "products", "stage_history", "deal_products"):
        assert rows(again[table]) == rows(tables[table])


def test_a_malformed_number_aborts_unless_quarantined(spark, raw):
    bad = raw["payments"].withColumn(
        "amount", F.when(F.col("payment_id") == "Y1", "ten").otherwise(F.col("amount")))
    with pytest.raises(Exception, match="not a valid decimal"):
        Cleaned({**raw, "payments": bad})["payments"].collect()
    lenient = Cleaned({**raw, "payments": bad}, Options(on_cast_error="quarantine"))
    assert "Y1" not in {r.payment_id for r in lenient["payments"].collect()}
    found = lenient.entries("payments").filter("record_key = 'Y1'").collect()
    assert [(f.severity, f.rule_id, f.reason) for f in found] == [
        ("error", "CAST_FAILED", "amount is not decimal(14,2): ten")]


def test_a_malformed_number_in_a_dropped_row_does_not_abort(tables):
    assert "A-99" not in {r.deal_id for r in tables["deal_products"].collect()}


def test_empty_exports(spark):
    from dealtide.model import raw_schema

    empty = {t: spark.createDataFrame([], raw_schema(t)) for t in RAW_COLUMNS}
    cleaned = Cleaned(empty)
    for table in TABLES:
        if table != "rejects":
            assert cleaned[table].count() == (1 if table == "pipeline_stages" else 0)


@pytest.fixture
def with_unknown_manager(raw):
    manager = F.when(F.col("deal_id") == "A-1", "M9").otherwise(F.col("manager_id"))
    role = F.when(F.col("user_id") == "M4", "captain").otherwise(F.col("role"))
    return {**raw, "deals": raw["deals"].withColumn("manager_id", manager),
            "users": raw["users"].withColumn("role", role)}


def test_a_broken_constraint_leaves_no_snapshot(spark, with_unknown_manager, tmp_path):
    with pytest.raises(ConstraintError) as error:
        refresh(spark, with_unknown_manager, str(tmp_path), run_id="bad")
    assert error.value.broken == [("users", "DOMAIN", "role", 1)]
    assert not (tmp_path / "bad" / "_manifest").exists()


def test_broken_constraints_can_be_quarantined(spark, with_unknown_manager, tmp_path):
    folder = refresh(spark, with_unknown_manager, str(tmp_path), constraints="quarantine")
    tables = read_snapshot(spark, folder, verify=True)
    assert tables["users"].count() == 3 and tables["deals"].count() == 10
    assert "A-1" not in {r.deal_id for r in tables["payments"].collect()}
    found = rows(tables["rejects"].filter("rule_id LIKE '%:%'"), "source_table", "record_key",
                 "rule_id")
    assert found == [("deals", "A-1", "REFERENCE:manager_id"), ("users", "M4", "DOMAIN:role")]


def test_fixture_covers_all_exports():
    assert {p.stem for p in DATA.glob("*.csv")} == set(RAW_COLUMNS)
    assert cleaning.DEFAULTS == Options()
