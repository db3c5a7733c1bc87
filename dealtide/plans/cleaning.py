"""From the raw exports to the typed tables, one function per table.

Every function returns annotated rows (see :mod:`dealtide.operators.findings`). The parents that
a function asks for are the *accepted* tables: a line of a dropped product is an orphan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealtide.functions import blank_to_null, parse_ts, source_key, source_name
from dealtide.model import EXACT, RAW_COLUMNS, TABLES, UNKNOWN_STAGE, UNKNOWN_STAGE_ROW
from dealtide.operators.duplicates import add_id, mark_duplicates
from dealtide.operators.findings import Finding, Parsed, annotate
from dealtide.operators.references import (
    Lookup, mark_known, mark_known_by_exceptions, parent_keys,
)


@dataclass(frozen=True)
class Options:
    """How to read doubtful values.

    ``on_cast_error``: ``fail`` aborts the load on a malformed number, flag or date;
    ``quarantine`` drops the row and journals it. ``naive_tz``: time zone of timestamps without
    an offset. ``won_stage``: the stage whose deals must have a closing date.
    """

    on_cast_error: str = "fail"
    naive_tz: str = "UTC"
    won_stage: str = "WON"


DEFAULTS = Options()


def _text(column: str) -> Column:
    return blank_to_null(F.col(column))


def _texts(*columns: str) -> dict[str, Column]:
    return {c: _text(c) for c in columns}


def _annotate(rows, table, key, values, findings=(), options=DEFAULTS) -> DataFrame:
    return annotate(
        rows, table, RAW_COLUMNS[table], key, values, findings,
        options.on_cast_error, options.naive_tz,
    )


# ---- dimensions ---------------------------------------------------------------------------


def sources(raw_deals: DataFrame, raw_costs: DataFrame) -> DataFrame:
    """Lead sources, from every spelling in deals and costs (also of deals dropped later).

    The spellings are made distinct first: the key is computed once per spelling, not per row.
    """
    spellings = raw_deals.select("source").union(raw_costs.select("source")).distinct()
    keys = (
        spellings.select(source_key(F.col("source")).alias("source_id"))
        .filter(F.col("source_id").isNotNull())
        .distinct()
    )
    return keys.withColumn("name", source_name(F.col("source_id")))


def users(raw: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    values = {
        "user_id": F.col("user_id"),
        "name": F.col("name"),
        "active": Parsed(F.col("active")),
        **_texts("role", "department", "email"),
    }
    return _annotate(raw, "users", F.col("user_id"), values, options=options)


def pipeline_stages(raw: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """Stages as exported. :func:`with_unknown_stage` adds the service stage."""
    values = {
        "stage_id": F.col("stage_id"),
        "pipeline_id": F.col("pipeline_id"),
        "stage_name": F.col("stage_name"),
        "sort_order": Parsed(F.col("sort_order")),
        "is_final": Parsed(F.col("is_final")),
        "is_success": Parsed(F.col("is_success")),
    }
    return _annotate(raw, "pipeline_stages", F.col("stage_id"), values, options=options)


def with_unknown_stage(stages: DataFrame) -> DataFrame:
    """Add the service stage. (A range row, not local data: Spark knows that it is tiny.)"""
    spec = TABLES["pipeline_stages"]
    row = stages.sparkSession.range(1).select(
        *[F.lit(UNKNOWN_STAGE_ROW[c]).cast(spec.type_of(c)).alias(c) for c in spec.columns]
    )
    return stages.unionByName(row)


def companies(raw: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    values = {
        "company_id": F.col("company_id"),
        "created_at": Parsed(F.col("created_at")),
        **_texts("name", "inn", "city", "industry"),
    }
    findings = [Finding("NAME_BLANK", "warning", _text("name").isNull(), "company without a name")]
    return _annotate(raw, "companies", F.col("company_id"), values, findings, options)


def products(raw: DataFrame, raw_lines: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """One product per sku: first the ones used in deal lines, then the smallest id."""
    rows = mark_duplicates(
        _with_use(raw, raw_lines), ["sku"], _product_preference(), flag="_duplicate"
    )
    values = {
        "product_id": F.col("product_id"),
        "sku": F.col("sku"),
        "name": F.col("name"),
        "category": _text("category"),
        "cost_price": Parsed(F.col("cost_price")),
        "is_active": Parsed(F.col("is_active")),
    }
    message = F.concat(F.lit("sku "), "sku", F.lit(" is already taken by a preferred product"))
    findings = [
        Finding("SKU_DUPLICATE", "warning", F.col("_duplicate"), message, drops=True),
        Finding("SKU_NULL", "warning", F.col("sku").isNull(), "product without a sku"),
    ]
    return _annotate(rows, "products", F.col("product_id"), values, findings, options)


def _with_use(raw: DataFrame, raw_lines: DataFrame) -> DataFrame:
    return mark_known(raw, "product_id", parent_keys(raw_lines, "product_id"), "_used")


def _product_preference() -> list[Column]:
    return [F.col("_used").desc(), F.col("product_id").asc_nulls_last()]


# ---- contacts and deals -------------------------------------------------------------------


def contacts(raw: DataFrame, companies: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    keys = parent_keys(companies, "company_id")
    rows = mark_known_by_exceptions(raw, "company_id", keys, "_known")
    values = {
        "contact_id": F.col("contact_id"),
        "company_id": F.when(F.col("_known"), F.col("company_id")),
        "created_at": Parsed(F.col("created_at")),
        **_texts("name", "phone", "email"),
    }
    message = F.concat(F.lit("company "), "company_id", F.lit(" does not exist; set to NULL"))
    unknown = _text("company_id").isNotNull() & ~F.col("_known")
    findings = [Finding("COMPANY_UNKNOWN", "warning", unknown, message)]
    return _annotate(rows, "contacts", F.col("contact_id"), values, findings, options)


def deals(raw: DataFrame, stages: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """The latest version of every deal; bad amounts become NULL, unknown stages UNKNOWN.

    A deal gets one finding at most, the first that applies.
    """
    updated = parse_ts(F.col("updated_at"), options.naive_tz)
    rows = mark_duplicates(raw, ["deal_id"], [updated.desc_nulls_last()])
    rows = mark_known(rows, "stage_id", parent_keys(stages, "stage_id"), "_known_stage")
    latest = ~F.col("_duplicate")
    # The sign is that of the text: -0.001 is negative although it rounds to 0.00.
    rows = rows.withColumn(
        "_negative",
        F.coalesce(latest & (F.col("expected_amount").try_cast(EXACT) < 0), F.lit(False)),
    )
    amount = F.when(~F.col("_negative"), F.col("expected_amount"))
    values = {
        "deal_id": F.col("deal_id"),
        "created_at": Parsed(F.col("created_at")),
        "updated_at": Parsed(F.col("updated_at")),
        "stage_id": F.when(F.col("_known_stage"), F.col("stage_id")).otherwise(UNKNOWN_STAGE),
        "source_id": source_key(F.col("source")),
        "expected_amount": Parsed(amount),
        "closed_at": Parsed(F.col("closed_at")),
        "custom_deadline": Parsed(_text("custom_deadline")),
        **_texts("title", "manager_id", "company_id", "contact_id", "currency", "lost_reason"),
    }
    unknown_stage = F.col("stage_id").isNotNull() & ~F.col("_known_stage")
    not_closed = (F.col("stage_id") == options.won_stage) & _text("closed_at").isNull()
    stage_message = F.concat(F.lit("unknown stage "), "stage_id", F.lit(f"; set to {UNKNOWN_STAGE}"))
    findings = [
        Finding("DEAL_DUPLICATE", "warning", ~latest, "an older version of the deal", drops=True),
        Finding("AMOUNT_NEGATIVE", "warning", F.col("_negative"),
                "negative expected_amount; set to NULL"),
        Finding("STAGE_UNKNOWN", "warning", latest & ~F.col("_negative") & unknown_stage,
                stage_message),
        Finding("WON_NOT_CLOSED", "warning",
                latest & ~F.col("_negative") & ~unknown_stage & not_closed,
                "won deal without closed_at"),
    ]
    return _annotate(rows, "deals", F.col("deal_id"), values, findings, options)


# ---- children of deals --------------------------------------------------------------------


def _no_deal(rule_id: str = "DEAL_MISSING") -> list[Finding]:
    """A child without its deal is dropped; so is one that names no deal at all."""
    message = F.concat(F.lit("deal "), "deal_id", F.lit(" does not exist"))
    return [
        Finding(rule_id, "error", F.col("deal_id").isNotNull() & ~F.col("_deal"), message,
                drops=True),
        Finding("FK_NULL", "error", F.col("deal_id").isNull(), "deal_id is empty", drops=True),
    ]


def _with_deal(raw: DataFrame, deals: DataFrame) -> DataFrame:
    return mark_known_by_exceptions(raw, "deal_id", parent_keys(deals, "deal_id"), "_deal")


def deal_products(
    raw: DataFrame, deals: DataFrame, products: DataFrame, options: Options = DEFAULTS
) -> DataFrame:
    rows = Lookup(raw, [
        ("deal_id", parent_keys(deals, "deal_id"), "_deal"),
        ("product_id", parent_keys(products, "product_id"), "_product"),
    ]).mark(raw)
    no_deal = F.col("deal_id").isNotNull() & ~F.col("_deal")
    no_product = F.col("product_id").isNotNull() & ~F.col("_product")
    values = {
        "deal_id": F.col("deal_id"),
        "product_id": F.col("product_id"),
        "quantity": Parsed(F.col("quantity")),
        "unit_price": Parsed(F.col("unit_price")),
        "discount": Parsed(F.col("discount")),
    }
    message = F.concat_ws(
        " and ", F.when(no_deal, F.lit("deal_id")), F.when(no_product, F.lit("product_id"))
    )
    null_key = F.col("deal_id").isNull() | F.col("product_id").isNull()
    findings = [
        Finding("REFERENCE_MISSING", "error", no_deal | no_product,
                F.concat(message, F.lit(" without a row in the parent table")), drops=True),
        Finding("FK_NULL", "error", null_key & ~(no_deal | no_product),
                "deal_id or product_id is empty", drops=True),
    ]
    key = F.concat("deal_id", F.lit("/"), "product_id")
    return _annotate(rows, "deal_products", key, values, findings, options)


def payments(raw: DataFrame, deals: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """Payments; a negative amount is a correction and stays."""
    values = {
        "payment_id": F.col("payment_id"),
        "deal_id": F.col("deal_id"),
        "payment_date": Parsed(F.col("payment_date"), as_instant=True),
        "amount": Parsed(F.col("amount")),
        **_texts("payment_type", "status"),
    }
    rows = _with_deal(raw, deals)
    return _annotate(rows, "payments", F.col("payment_id"), values, _no_deal(), options)


def activities(raw: DataFrame, deals: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    values = {
        "activity_id": F.col("activity_id"),
        "deal_id": F.col("deal_id"),
        "completed": Parsed(F.col("completed")),
        "deadline_at": Parsed(F.col("deadline_at")),
        "completed_at": Parsed(F.col("completed_at")),
        **_texts("activity_type", "direction", "subject", "responsible_user_id"),
    }
    rows = _with_deal(raw, deals)
    return _annotate(rows, "activities", F.col("activity_id"), values, _no_deal(), options)


def stage_history(
    raw: DataFrame, deals: DataFrame, stages: DataFrame, options: Options = DEFAULTS
) -> DataFrame:
    """Stage changes, one row per event. Copies of an orphan event are all journalled as such."""
    orphans = Lookup(raw, [("deal_id", parent_keys(deals, "deal_id"), "_deal")])
    rows = mark_duplicates(raw, ["event_id"], [F.col("changed_at").asc_nulls_last()])
    rows = orphans.mark(rows)
    known = parent_keys(stages, "stage_id")
    rows = mark_known(rows, "old_stage_id", known, "_old_known")
    rows = mark_known(rows, "new_stage_id", known, "_new_known")

    def stage(column: str, known_flag: str) -> Column:
        other = F.when(_text(column).isNotNull(), F.lit(UNKNOWN_STAGE))
        return F.when(F.col(known_flag), F.col(column)).otherwise(other)

    values = {
        "event_id": F.col("event_id"),
        "deal_id": F.col("deal_id"),
        "old_stage_id": stage("old_stage_id", "_old_known"),
        "new_stage_id": stage("new_stage_id", "_new_known"),
        "changed_at": Parsed(F.col("changed_at")),
        "changed_by_id": _text("changed_by_id"),
    }
    findings = [
        Finding("EVENT_DUPLICATE", "warning", F.col("_duplicate"), "a copy of the event",
                drops=True),
        *_no_deal(),
    ]
    return _annotate(rows, "stage_history", F.col("event_id"), values, findings, options)


def production_orders(raw: DataFrame, deals: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    values = {
        "production_order_id": F.col("production_order_id"),
        "deal_id": F.col("deal_id"),
        "created_at": Parsed(F.col("created_at")),
        "planned_finish_at": Parsed(_text("planned_finish_at")),
        "actual_finish_at": Parsed(_text("actual_finish_at")),
        **_texts("status", "workshop"),
    }
    rows = _with_deal(raw, deals)
    key = F.col("production_order_id")
    return _annotate(rows, "production_orders", key, values, _no_deal(), options)


def shipments(raw: DataFrame, deals: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    values = {
        "shipment_id": F.col("shipment_id"),
        "deal_id": F.col("deal_id"),
        "planned_date": Parsed(_text("planned_date")),
        "actual_date": Parsed(_text("actual_date")),
        "status": _text("status"),
    }
    rows = _with_deal(raw, deals)
    findings = _no_deal("SHIPMENT_DEAL_MISSING")
    return _annotate(rows, "shipments", F.col("shipment_id"), values, findings, options)


def marketing_costs(raw: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    rows = add_id(raw, "_id", RAW_COLUMNS["marketing_costs"])
    values = {
        "cost_id": F.col("_id"),
        "cost_date": Parsed(F.col("cost_date")),
        "source_id": source_key(F.col("source")),
        "campaign": _text("campaign"),
        "cost_amount": Parsed(F.col("cost_amount")),
        "currency": _text("currency"),
    }
    return _annotate(rows, "marketing_costs", F.col("source"), values, options=options)
