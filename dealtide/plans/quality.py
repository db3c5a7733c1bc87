"""Further quality rules, on cleaned tables. Each returns the rows that a person should look at,
or a column set to a standard form.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealtide.functions import day, local_date, phone_number
from dealtide.model import UNKNOWN_STAGE
from dealtide.operators.unions import union_all
from dealtide.plans.reports import Day

Tables = Mapping[str, DataFrame]

# Defaults and standard codes.
DEFAULT_CURRENCY = "RUB"
PAYMENT_TYPES = ("prepayment", "full", "correction")
OTHER_PAYMENT_TYPE = "other"
FIRST_STAGE = "NEW"
#: where a deal may be moved to from the UNKNOWN stage, by hand
RECOVERY_STAGE = "QUALIFICATION"


# ---- values in a standard form ------------------------------------------------------------


def standard_phones(contacts: DataFrame) -> DataFrame:
    """Phones as ``+7XXXXXXXXXX`` where they are Russian numbers."""
    return contacts.withColumn("phone", phone_number(F.col("phone")))


def default_currency(df: DataFrame, currency: str = DEFAULT_CURRENCY) -> DataFrame:
    """A missing currency filled in; ``currency_assumed`` tells where."""
    return df.withColumn("currency_assumed", F.col("currency").isNull()).withColumn(
        "currency", F.coalesce("currency", F.lit(currency))
    )


def standard_payment_types(
    payments: DataFrame, known: tuple[str, ...] = PAYMENT_TYPES
) -> DataFrame:
    """Payment types outside the known ones become ``other``; a missing type stays NULL."""
    kind = F.col("payment_type")
    return payments.withColumn(
        "payment_type",
        F.when(kind.isNull() | kind.isin(*known), kind).otherwise(F.lit(OTHER_PAYMENT_TYPE)),
    )


# ---- amounts ------------------------------------------------------------------------------


def overpaid(receivables: DataFrame) -> DataFrame:
    """Lines of the receivables report with a flag for overpayment."""
    return receivables.withColumn("overpaid", F.col("remaining") < 0)


def negative_payments(tables: Tables) -> DataFrame:
    return tables["payments"].filter(F.col("amount") < 0)


# ---- dates --------------------------------------------------------------------------------


def facts_after_close(tables: Tables, naive_tz: str = "UTC") -> DataFrame:
    """Production finished or goods shipped after the day on which, in ``naive_tz``, the deal was
    closed."""
    closed = tables["deals"].filter(F.col("closed_at").isNotNull()).select(
        "deal_id", local_date(F.col("closed_at"), naive_tz).alias("closed_on")
    )
    facts = _dated(tables, "actual_finish_at", "actual_date", "happened_on").filter(
        F.col("happened_on").isNotNull()
    )
    return facts.join(closed, "deal_id").filter(F.col("happened_on") > F.col("closed_on"))


def _dated(tables: Tables, production: str, shipment: str, name: str) -> DataFrame:
    def part(table: str, key: str, column: str) -> DataFrame:
        return tables[table].select(
            F.lit(table).alias("source_table"), F.col(key).alias("record_key"), "deal_id",
            F.col(column).alias(name),
        )

    return part("production_orders", "production_order_id", production).unionByName(
        part("shipments", "shipment_id", shipment)
    )


def overdue(tables: Tables, as_of: Day = None) -> DataFrame:
    """Orders, shipments and open deals whose planned day has passed without a result."""
    orders = tables["production_orders"].filter(F.col("actual_finish_at").isNull()).select(
        F.lit("production_orders").alias("source_table"),
        F.col("production_order_id").alias("record_key"), "deal_id",
        F.col("planned_finish_at").alias("due_on"),
    )
    shipments = tables["shipments"].filter(F.col("actual_date").isNull()).select(
        F.lit("shipments").alias("source_table"), F.col("shipment_id").alias("record_key"),
        "deal_id", F.col("planned_date").alias("due_on"),
    )
    open_stages = tables["pipeline_stages"].filter(~F.col("is_final")).select("stage_id")
    deals = (
        tables["deals"].filter(F.col("closed_at").isNull())
        .join(open_stages, "stage_id", "left_semi")
        .select(F.lit("deals").alias("source_table"), F.col("deal_id").alias("record_key"),
                "deal_id", F.col("custom_deadline").alias("due_on"))
    )
    late = F.datediff(day(as_of), F.col("due_on"))
    return (
        orders.unionByName(shipments).unionByName(deals)
        .withColumn("days_late", late)
        .filter(F.col("days_late") > 0)
    )


def final_without_close(tables: Tables) -> DataFrame:
    """Deals in any final stage, won or lost, without a closing date."""
    final = tables["pipeline_stages"].filter("is_final").select("stage_id")
    return tables["deals"].filter(F.col("closed_at").isNull()).join(final, "stage_id", "left_semi")


def lost_without_reason(tables: Tables) -> DataFrame:
    """Deals in a final stage that is no success, without a reason for the loss."""
    lost = tables["pipeline_stages"].filter("is_final AND NOT is_success").select("stage_id")
    return tables["deals"].filter(F.col("lost_reason").isNull()).join(lost, "stage_id", "left_semi")


# ---- dimensions ---------------------------------------------------------------------------


def unused_empty_companies(tables: Tables) -> DataFrame:
    """Companies without name, tax number and industry that no deal or contact refers to."""
    empty = tables["companies"].filter("name IS NULL AND inn IS NULL AND industry IS NULL")
    used = union_all([tables[t].select("company_id") for t in ("deals", "contacts")]).distinct()
    return empty.join(used, "company_id", "left_anti")


# ---- stage history ------------------------------------------------------------------------


def _ranked_stages(stages: DataFrame) -> DataFrame:
    """Stages with their place in the pipeline (the service stage has none of its own).

    The window is per pipeline, over a handful of stages.
    """
    place = F.row_number().over(Window.partitionBy("pipeline_id").orderBy("sort_order", "stage_id"))
    return stages.withColumn("place", place).select(
        "stage_id", "sort_order", "is_final", "is_success", "place"
    )


def transitions(tables: Tables) -> DataFrame:
    """Every stage change with a ``verdict`` and the number of working stages it skips.

    Legal: ``start`` (into the first stage), ``forward`` (to any later stage), ``lost`` (from
    any working stage) and ``recovered`` (out of the service stage). Others name the fault.
    """
    stages = _ranked_stages(tables["pipeline_stages"])
    fields = stages.columns

    def side(prefix: str) -> DataFrame:
        return stages.select(*[F.col(c).alias(f"{prefix}_{c}") for c in fields])

    rows = (
        tables["stage_history"]
        .join(side("old").withColumnRenamed("old_stage_id", "_old"),
              F.col("old_stage_id") == F.col("_old"), "left")
        .join(side("new").withColumnRenamed("new_stage_id", "_new"),
              F.col("new_stage_id") == F.col("_new"), "left")
    )
    old, new = F.col("old_stage_id"), F.col("new_stage_id")
    verdict = (
        F.when(new.isNull() | (new == UNKNOWN_STAGE), "to_unknown")
        .when(old.isNull() & (new == FIRST_STAGE), "start")
        .when(old.isNull(), "bad_start")
        .when((old == UNKNOWN_STAGE) & (new == RECOVERY_STAGE), "recovered")
        .when(old == UNKNOWN_STAGE, "from_unknown")
        .when(F.col("old_is_final"), "from_final")
        .when(F.col("new_is_final") & ~F.col("new_is_success"), "lost")
        .when(F.col("new_sort_order") > F.col("old_sort_order"), "forward")
        .when(F.col("new_sort_order") == F.col("old_sort_order"), "repeated")
        .otherwise("backward")
    )
    skipped = F.when(verdict == "forward", F.col("new_place") - F.col("old_place") - 1)
    return rows.select(
        *tables["stage_history"].columns, verdict.alias("verdict"), skipped.alias("skipped_stages")
    )


LEGAL = ("start", "forward", "lost", "recovered")


def illegal_transitions(tables: Tables) -> DataFrame:
    return transitions(tables).filter(~F.col("verdict").isin(*LEGAL))


def skipped_stages(tables: Tables) -> DataFrame:
    """Legal changes that jump over at least one stage."""
    return transitions(tables).filter(F.col("skipped_stages") > 0)


def history_gaps(tables: Tables) -> DataFrame:
    """Deals whose stage is not the last one in their history, or that have no history."""
    last = tables["stage_history"].groupBy("deal_id").agg(
        F.max(F.struct("changed_at", "event_id", "new_stage_id"))["new_stage_id"].alias("last_stage"),
        F.count("*").alias("changes"),
    )
    deals = tables["deals"].select("deal_id", "stage_id")
    verdict = F.when(F.col("changes").isNull(), "no_history").when(
        ~F.col("last_stage").eqNullSafe(F.col("stage_id")), "other_stage"
    )
    return (
        deals.join(last, "deal_id", "left")
        .select("deal_id", "stage_id", "last_stage", verdict.alias("verdict"))
        .filter(F.col("verdict").isNotNull())
    )
