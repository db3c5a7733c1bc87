"""The business reports, with their parameters.

Facts are aggregated by key before they are joined, so that hot keys shrink in the map tasks and
no join multiplies rows. Every report is sorted at its very end, with its key as the last sort
column: the order is total, and equal values do not pile up in one range of the sort.

``tables`` maps the names of the model to cleaned tables. Periods are half-open: ``start`` is in,
``end`` is not.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealtide.functions import day
from dealtide.operators.findings import with_fields
from dealtide.sources.snapshot import Snapshot, period

Tables = Mapping[str, DataFrame]
Day = datetime.date | datetime.datetime | str | None

# Payment statuses that the receivables distinguish.
PAID, PENDING = "paid", "pending"

UNASSIGNED = "not assigned"


def _or_zero(amount: Column) -> Column:
    return F.coalesce(amount, F.lit(0).cast("decimal(14,2)"))


def _period(tables: Tables, table: str, column: str, start: Day, end: Day) -> DataFrame:
    """Rows of a period; of a stored run only the partitions of its months."""
    if isinstance(tables, Snapshot):
        return tables.between(table, column, start, end)
    return period(tables[table], column, start, end)


def deal_economics(tables: Tables, deals: DataFrame | None = None) -> DataFrame:
    """Revenue and cost of the deals that have lines: ``(deal_id, revenue, cost, margin)``.

    The discount is an amount per line, not a percentage. ``deals``: only lines of these are priced.
    """
    lines = tables["deal_products"].select("deal_id", "product_id", "quantity", "unit_price",
                                           "discount")
    if deals is not None:
        lines = lines.join(deals.select("deal_id"), "deal_id", "left_semi")
    costs = tables["products"].select("product_id", "cost_price")
    return (
        lines.join(costs, "product_id")
        .groupBy("deal_id")
        .agg(
            F.sum(F.col("quantity") * F.col("unit_price") - F.col("discount")).alias("revenue"),
            F.sum(F.col("quantity") * F.col("cost_price")).alias("cost"),
        )
        .withColumn("margin", F.col("revenue") - F.col("cost"))
    )


def funnel(tables: Tables, start: Day = None, end: Day = None) -> DataFrame:
    """Deals and their expected amount by stage; stages without deals are kept."""
    deals = _period(tables, "deals", "created_at", start, end)
    by_stage = deals.groupBy("stage_id").agg(
        F.count("deal_id").alias("deals_count"), F.sum("expected_amount").alias("amount_total")
    )
    stages = tables["pipeline_stages"].select("sort_order", "stage_id", "stage_name")
    return stages.join(by_stage, "stage_id", "left").select(
        "sort_order", "stage_id", "stage_name",
        F.coalesce("deals_count", F.lit(0)).alias("deals_count"),
        _or_zero(F.col("amount_total")).alias("amount_total"),
    ).orderBy("sort_order", "stage_id")


def managers(
    tables: Tables,
    start: Day = None,
    end: Day = None,
    won: bool = False,
    include_unassigned: bool = False,
) -> DataFrame:
    """Deals, revenue and margin by manager.

    ``won`` counts only deals in a success stage. ``include_unassigned`` adds one line for the
    deals without a manager.
    """
    deals = _period(tables, "deals", "created_at", start, end)
    filtered = won or start is not None or end is not None
    if won:
        success = tables["pipeline_stages"].filter("is_success").select("stage_id")
        deals = deals.join(success, "stage_id", "left_semi")
    if not include_unassigned:
        deals = deals.filter(F.col("manager_id").isNotNull())
    by_manager = (
        deals.select("deal_id", "manager_id")
        .join(deal_economics(tables, deals if filtered else None), "deal_id", "left")
        .groupBy("manager_id")
        .agg(
            F.count("deal_id").alias("deals_count"),
            F.sum("revenue").alias("revenue"),
            F.sum("margin").alias("margin"),
        )
    )
    users = tables["users"].select("user_id", "name")
    if include_unassigned:
        named = by_manager.join(users, F.col("manager_id") == F.col("user_id"), "left").filter(
            F.col("user_id").isNotNull() | F.col("manager_id").isNull()
        )
        name = F.coalesce("name", F.lit(UNASSIGNED))
    else:
        named = by_manager.join(users, F.col("manager_id") == F.col("user_id"))
        name = F.col("name")
    margin, revenue = F.col("margin"), F.col("revenue")
    # Few integer digits leave the quotient enough decimals to be rounded from.
    share = _or_zero(margin).cast("decimal(28,2)") * 100 / F.nullif(
        revenue.cast("decimal(28,2)"), F.lit(0).cast("decimal(28,2)")
    )
    return named.select(
        "user_id", name.alias("name"), "deals_count",
        _or_zero(revenue).alias("revenue"),
        _or_zero(margin).alias("margin"),
        F.round(share, 1).alias("margin_pct"),
    ).orderBy(F.desc("revenue"), F.asc_nulls_last("user_id"))


def receivables(
    tables: Tables, min_remaining: float | str | None = None, include_unlinked: bool = False
) -> DataFrame:
    """Expected amount, payments and remainder of every deal with an amount or a payment.

    Only paid payments count; a negative remainder is an overpayment. ``include_unlinked`` adds
    the payments in the journal whose deal does not exist, under the deal that they name.
    """
    paid = _payment_sums(tables["payments"])
    deals = tables["deals"].select("deal_id", "stage_id", "expected_amount")
    rows = deals.join(paid.withColumn("_paying", F.lit(True)), "deal_id", "left").filter(
        F.col("expected_amount").isNotNull() | F.col("_paying").isNotNull()
    ).drop("_paying")
    if include_unlinked:
        lost = _payment_sums(unlinked_payments(tables["rejects"]))
        rows = rows.unionByName(lost, allowMissingColumns=True)
    result = rows.select(
        "deal_id", "stage_id", "expected_amount",
        _or_zero(F.col("paid")).alias("paid"),
        _or_zero(F.col("pending")).alias("pending"),
        (_or_zero(F.col("expected_amount")) - _or_zero(F.col("paid"))).alias("remaining"),
    )
    if min_remaining is not None:
        result = result.filter(F.col("remaining") >= F.lit(str(min_remaining)).cast("decimal(14,2)"))
    return result.orderBy(F.desc("remaining"), "deal_id")


def _payment_sums(payments: DataFrame) -> DataFrame:
    def amount(status: str) -> Column:
        return F.sum(F.when(F.col("status") == status, F.col("amount")))

    return payments.groupBy("deal_id").agg(
        amount(PAID).alias("paid"), amount(PENDING).alias("pending")
    )


def unlinked_payments(rejects: DataFrame) -> DataFrame:
    """Payments that the cleaning dropped because their deal does not exist."""
    lost = rejects.filter((F.col("source_table") == "payments") & (F.col("rule_id") == "DEAL_MISSING"))
    fields = with_fields(lost.select("raw_data"), {c: c for c in ("deal_id", "amount", "status")})
    return fields.select("deal_id", F.col("amount").try_cast("decimal(14,2)").alias("amount"), "status")


def production_delays(tables: Tables, as_of: Day = None, days: int = 5) -> DataFrame:
    """Production orders more than ``days`` late; an open one counts up to ``as_of``."""
    delay = F.datediff(F.coalesce("actual_finish_at", day(as_of)), F.col("planned_finish_at"))
    return (
        tables["production_orders"]
        .select("production_order_id", "deal_id", "workshop", "status", "planned_finish_at",
                "actual_finish_at", delay.alias("delay_days"))
        .filter(F.col("delay_days") > days)
        .orderBy(F.desc("delay_days"), "production_order_id")
    )


def stale_deals(tables: Tables, as_of: Day = None, days: int = 7) -> DataFrame:
    """Deals in open stages without an activity in the last ``days`` days.

    An activity counts at its completion, or at its deadline while it is open. Deals that never
    had one come first, with NULL.
    """
    last = tables["activities"].groupBy("deal_id").agg(
        F.max(F.coalesce("completed_at", "deadline_at")).alias("last_activity_at")
    )
    open_stages = tables["pipeline_stages"].filter(~F.col("is_final")).select("stage_id")
    deals = tables["deals"].select("deal_id", "stage_id", "manager_id")
    limit = F.date_sub(day(as_of), days).cast("timestamp")
    return (
        deals.join(open_stages, "stage_id", "left_semi")
        .join(last, "deal_id", "left")
        .filter(F.col("last_activity_at").isNull() | (F.col("last_activity_at") < limit))
        .select("deal_id", "stage_id", "manager_id", "last_activity_at")
        .orderBy(F.asc_nulls_first("last_activity_at"), "deal_id")
    )


def lead_sources(
    tables: Tables, start: Day = None, end: Day = None, with_romi: bool = False
) -> DataFrame:
    """Deals, revenue, margin, marketing cost and net result by lead source; all are kept.

    The period applies to the creation of deals and to the date of costs. ``with_romi`` adds
    ``net / marketing_cost``, NULL without costs.
    """
    deals = _period(tables, "deals", "created_at", start, end)
    filtered = start is not None or end is not None
    by_source = (
        deals.filter(F.col("source_id").isNotNull())
        .select("deal_id", "source_id")
        .join(deal_economics(tables, deals if filtered else None), "deal_id", "left")
        .groupBy("source_id")
        .agg(
            F.count("deal_id").alias("deals_count"),
            F.sum("revenue").alias("revenue"),
            F.sum("margin").alias("margin"),
        )
    )
    costs = _period(tables, "marketing_costs", "cost_date", start, end)
    spent = costs.groupBy("source_id").agg(F.sum("cost_amount").alias("marketing_cost"))
    margin, cost = _or_zero(F.col("margin")), _or_zero(F.col("marketing_cost"))
    columns = [
        F.col("source_id"), F.col("name"),
        F.coalesce("deals_count", F.lit(0)).alias("deals_count"),
        _or_zero(F.col("revenue")).alias("revenue"),
        margin.alias("margin"),
        cost.alias("marketing_cost"),
        (margin - cost).alias("net"),
    ]
    if with_romi:
        spend = F.nullif(cost.cast("decimal(28,2)"), F.lit(0).cast("decimal(28,2)"))
        net = margin.cast("decimal(28,2)") - cost.cast("decimal(28,2)")
        columns.append(F.round(net.cast("decimal(28,2)") / spend, 4).alias("romi"))
    return (
        tables["sources"].join(by_source, "source_id", "left").join(spent, "source_id", "left")
        .select(*columns)
        .orderBy(F.desc("revenue"), F.desc("deals_count"), "source_id")
    )


def defect_summary(
    tables: Tables, severity: str | None = None, run_id: str | None = None
) -> DataFrame:
    """Journal entries by severity and table, of all runs in it or of one."""
    return (
        _journal(tables, severity, run_id)
        .groupBy("severity", "source_table")
        .agg(F.count("*").alias("cnt"))
        .orderBy("severity", "source_table")
    )


def defect_detail(
    tables: Tables, severity: str | None = None, run_id: str | None = None
) -> DataFrame:
    """Journal entries one by one, of all runs in it or of one."""
    columns = ["severity", "source_table", "record_key", "reason"]
    return _journal(tables, severity, run_id).select(*columns).orderBy(
        "severity", "source_table", F.asc_nulls_last("record_key"), "reason"
    )


def _journal(tables: Tables, severity: str | None, run_id: str | None) -> DataFrame:
    rejects = tables["rejects"]
    if run_id is not None:
        rejects = rejects.filter(F.col("run_id") == run_id)
    return rejects if severity is None else rejects.filter(F.col("severity") == severity)


def register_views(spark: SparkSession, tables: Tables, as_of: Day = None) -> list[str]:
    """The reports with their default parameters as temporary views ``v_*`` for Spark SQL."""
    views = {
        "v_funnel": funnel(tables),
        "v_managers": managers(tables),
        "v_receivables": receivables(tables),
        "v_production_delays": production_delays(tables, as_of),
        "v_stale_deals": stale_deals(tables, as_of),
        "v_sources": lead_sources(tables),
        "v_data_quality": defect_summary(tables),
        "v_data_quality_detail": defect_detail(tables),
    }
    for name, report in views.items():
        report.createOrReplaceTempView(name)
    return list(views)
