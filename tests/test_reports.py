import datetime
from decimal import Decimal

import pytest
from conftest import AS_OF, rows

from dealtide.plans import quality, reports


def money(*amounts):
    return tuple(Decimal(a) for a in amounts)


def in_order(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_deal_economics(tables):
    got = {r.deal_id: (r.revenue, r.cost, r.margin)
           for r in reports.deal_economics(tables).collect()}
    assert got == {
        "A-1": money("240.00", "140.01", "99.99"),
        "A-3": money("800.00", "600.00", "200.00"),
        "A-9": money("30.00", "18.00", "12.00"),
    }


def test_funnel(tables):
    got = in_order(reports.funnel(tables), "stage_id", "deals_count", "amount_total")
    assert [(s, n, str(a)) for s, n, a in got] == [
        ("NEW", 2, "50.00"), ("QUALIFICATION", 1, "700.00"), ("CALCULATION", 0, "0.00"),
        ("PROPOSAL", 0, "0.00"), ("CONTRACT", 1, "2500.50"), ("PRODUCTION", 1, "1000.00"),
        ("SHIPPED", 0, "0.00"), ("WON", 2, "4500.00"), ("LOST", 1, "60.00"),
        ("UNKNOWN", 3, "300.00"),
    ]
    assert sum(n for _, n, _ in got) == tables["deals"].count()


def test_funnel_of_a_period_keeps_empty_stages(tables):
    got = in_order(reports.funnel(tables, "2025-03-03", "2025-03-05"), "stage_id", "deals_count")
    assert len(got) == 10 and {s for s, n in got if n} == {"WON"} and dict(got)["WON"] == 2


def test_managers(tables):
    got = in_order(reports.managers(tables), "user_id", "deals_count", "revenue", "margin",
                   "margin_pct")
    assert got == [
        ("M1", 5, *money("1070.00", "311.99", "29.2")),
        ("M2", 5, *money("0.00", "0.00"), None),
    ]


def test_managers_of_won_deals(tables):
    got = in_order(reports.managers(tables, won=True), "user_id", "deals_count", "margin_pct")
    assert got == [("M1", 1, Decimal("25.0")), ("M2", 1, None)]


def test_deals_without_a_manager_on_request(tables):
    got = in_order(reports.managers(tables, include_unassigned=True), "name", "deals_count")
    assert ("not assigned", 1) in got and len(got) == 3


def test_receivables(tables):
    got = in_order(reports.receivables(tables), "deal_id", "paid", "pending", "remaining")
    assert [(d, str(p), str(w), str(r)) for d, p, w, r in got] == [
        ("A-2", "-20.00", "0.00", "2520.50"),
        ("A-1", "100.00", "50.00", "900.00"),
        ("A-7", "0.00", "0.00", "700.00"),
        ("A-4", "0.00", "0.00", "500.00"),
        ("A-5", "0.00", "0.00", "300.00"),
        ("A-11", "0.00", "0.00", "60.00"),
        ("A-10", "0.00", "0.00", "40.00"),
        ("A-9", "0.00", "0.00", "10.00"),
        ("A-8", "15.00", "0.00", "-15.00"),
        ("A-3", "4500.00", "0.00", "-500.00"),
    ]


def test_receivables_above_a_limit(tables):
    got = in_order(reports.receivables(tables, min_remaining="700"), "deal_id")
    assert got == [("A-2",), ("A-1",), ("A-7",)]


def test_receivables_with_unlinked_payments(tables):
    got = rows(reports.receivables(tables, include_unlinked=True).filter("stage_id IS NULL"),
               "deal_id", "paid", "remaining")
    assert got == [("A-99", *money("70.00", "-70.00"))]


@pytest.mark.parametrize("days,expected", [(5, [("W1", 22), ("W2", 6)]),
                                           (4, [("W1", 22), ("W2", 6), ("W3", 5)])])
def test_production_delays(tables, days, expected):
    report = reports.production_delays(tables, AS_OF, days)
    assert in_order(report, "production_order_id", "delay_days") == expected


def test_stale_deals(tables):
    got = in_order(reports.stale_deals(tables, AS_OF), "deal_id", "last_activity_at")
    # The limit is 25 March 00:00: A-9 was active at that moment and is not stale.
    assert got == [
        *[(d, None) for d in ("A-10", "A-5", "A-6", "A-7", "A-8")],
        ("A-1", datetime.datetime(2025, 3, 24, 23, 59, 59)),
    ]
    later = {r.deal_id for r in reports.stale_deals(tables, "2025-04-10").collect()}
    assert later == {"A-1", "A-10", "A-2", "A-5", "A-6", "A-7", "A-8", "A-9"}


def test_lead_sources(tables):
    got = in_order(reports.lead_sources(tables, with_romi=True), "source_id", "deals_count",
                   "revenue", "margin", "marketing_cost", "net", "romi")
    assert [(s, n, *map(str, rest)) for s, n, *rest in got] == [
        ("web_site", 2, "800.00", "200.00", "0.00", "200.00", "None"),
        ("fair", 6, "270.00", "111.99", "60.00", "51.99", "0.8665"),
        ("yarmarka", 2, "0.00", "0.00", "20.00", "-20.00", "-1.0000"),
        ("radio", 0, "0.00", "0.00", "0.00", "0.00", "None"),
    ]


def test_period_of_sources_holds_for_deals_and_costs(tables):
    got = in_order(reports.lead_sources(tables, "2025-03-02", "2025-03-04"), "source_id",
                   "deals_count", "marketing_cost")
    assert {(s, n, str(c)) for s, n, c in got} == {
        ("web_site", 1, "0.00"), ("fair", 1, "0.00"), ("yarmarka", 0, "20.00"),
        ("radio", 0, "0.00")}


def test_revenue_by_source_is_that_of_the_deals_with_one(tables):
    by_source = reports.lead_sources(tables).agg({"revenue": "sum"}).first()[0]
    assert by_source <= reports.deal_economics(tables).agg({"revenue": "sum"}).first()[0]


def test_defects(tables):
    got = in_order(reports.defect_summary(tables, "error"), "source_table", "cnt")
    assert got == [("activities", 1), ("deal_products", 4), ("payments", 2),
                   ("production_orders", 1), ("shipments", 1), ("stage_history", 2)]
    detail = in_order(reports.defect_detail(tables), "severity", "source_table", "record_key")
    assert len(detail) == 27 and detail == sorted(
        detail, key=lambda d: (d[0], d[1], d[2] is None, d[2] or ""))


def test_views(spark, tables):
    names = reports.register_views(spark, tables, AS_OF)
    assert len(names) == 8
    assert spark.sql("SELECT sum(deals_count) FROM v_funnel").first()[0] == 11
    assert spark.sql("SELECT count(*) FROM v_data_quality_detail").first()[0] == 27


# ---- quality ------------------------------------------------------------------------------


def test_phones(tables):
    assert rows(quality.standard_phones(tables["contacts"]), "contact_id", "phone") == [
        ("H1", "+79025551401"), ("H2", "+79035550303"), ("H3", "ext. 12")]


def test_currency(tables):
    filled = quality.default_currency(tables["deals"]).filter("currency_assumed")
    assert rows(filled, "deal_id", "currency") == [("A-7", "RUB")]


def test_payment_types(tables):
    got = dict(rows(quality.standard_payment_types(tables["payments"]), "payment_id",
                    "payment_type"))
    assert got == {"Y1": "prepayment", "Y2": "full", "Y3": "full", "Y5": "correction",
                   "Y7": "other"}


def test_overpaid_and_negative(tables):
    flagged = quality.overpaid(reports.receivables(tables)).filter("overpaid")
    assert rows(flagged, "deal_id") == [("A-3",), ("A-8",)]
    assert rows(quality.negative_payments(tables), "payment_id") == [("Y5",)]


def test_facts_after_close(tables):
    got = rows(quality.facts_after_close(tables), "source_table", "record_key")
    assert got == [("shipments", "S1")]


def test_overdue(tables):
    got = rows(quality.overdue(tables, AS_OF), "source_table", "record_key", "days_late")
    assert got == [("deals", "A-1", 12), ("production_orders", "W1", 22), ("shipments", "S3", 17)]


def test_final_stages(tables):
    assert rows(quality.final_without_close(tables), "deal_id") == [("A-4",)]
    assert rows(quality.lost_without_reason(tables), "deal_id") == []


def test_unused_companies(tables):
    assert rows(quality.unused_empty_companies(tables), "company_id") == [("K3",), ("K4",)]


def test_transitions(tables):
    got = rows(quality.transitions(tables), "event_id", "verdict", "skipped_stages")
    assert got == [
        ("E1", "start", None), ("E2", "forward", 4), ("E4", "recovered", None),
        ("E5", "to_unknown", None), ("E6", "start", None), ("E7", "from_final", None),
        ("E8", "forward", 0), ("E9", "backward", None),
    ]
    assert rows(quality.illegal_transitions(tables), "event_id") == [("E5",), ("E7",), ("E9",)]
    assert rows(quality.skipped_stages(tables), "event_id") == [("E2",)]


def test_history_gaps(tables):
    got = dict(rows(quality.history_gaps(tables), "deal_id", "verdict"))
    assert got == {"A-3": "other_stage", "A-4": "other_stage", "A-5": "no_history",
                   "A-6": "no_history", "A-7": "no_history", "A-8": "no_history",
                   "A-9": "no_history", "A-10": "no_history"}


def test_a_period_prices_only_the_lines_of_its_deals(tables):
    for report in (
        reports.managers(tables, "2025-03-01", "2025-03-05"), reports.managers(tables, won=True),
        reports.lead_sources(tables, "2025-03-01", "2025-03-05"),
    ):
        lines = report._jdf.queryExecution().optimizedPlan().toString().splitlines()
        scan = next(n for n, line in enumerate(lines) if "quantity" in line and "Relation" in line)
        semi = [n for n, line in enumerate(lines) if "Join LeftSemi" in line and n < scan]
        sums = [n for n, line in enumerate(lines) if "Aggregate [deal_id" in line and n < scan]
        assert semi and sums and max(semi) > max(sums)
    assert "LeftSemi" not in reports.managers(tables)._jdf.queryExecution().optimizedPlan().toString()
