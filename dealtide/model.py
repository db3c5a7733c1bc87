"""Tables of the two layers: the raw exports and the typed model built from them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Names and order of the columns in the export files. All of them are text.
RAW_COLUMNS: dict[str, tuple[str, ...]] = {
    "deals": (
        "deal_id", "title", "created_at", "updated_at", "stage_id", "manager_id", "company_id",
        "contact_id", "source", "expected_amount", "currency", "closed_at", "lost_reason",
        "custom_deadline",
    ),
    "deal_products": ("deal_id", "product_id", "quantity", "unit_price", "discount"),
    "products": ("product_id", "sku", "name", "category", "cost_price", "is_active"),
    "payments": ("payment_id", "deal_id", "payment_date", "amount", "payment_type", "status"),
    "companies": ("company_id", "name", "inn", "city", "industry", "created_at"),
    "contacts": ("contact_id", "company_id", "name", "phone", "email", "created_at"),
    "users": ("user_id", "name", "role", "active", "department", "email"),
    "pipeline_stages": (
        "pipeline_id", "stage_id", "stage_name", "sort_order", "is_final", "is_success",
    ),
    "stage_history": (
        "event_id", "deal_id", "old_stage_id", "new_stage_id", "changed_at", "changed_by_id",
    ),
    "activities": (
        "activity_id", "deal_id", "activity_type", "direction", "subject", "responsible_user_id",
        "completed", "deadline_at", "completed_at",
    ),
    "production_orders": (
        "production_order_id", "deal_id", "created_at", "planned_finish_at", "actual_finish_at",
        "status", "workshop",
    ),
    "shipments": ("shipment_id", "deal_id", "planned_date", "actual_date", "status"),
    "marketing_costs": ("cost_date", "source", "campaign", "cost_amount", "currency"),
}

# The service stage that takes deals with an unknown stage.
UNKNOWN_STAGE = "UNKNOWN"
UNKNOWN_STAGE_ROW = {
    "stage_id": UNKNOWN_STAGE,
    "pipeline_id": "sales-main",
    "stage_name": "Неизвестная стадия",
    "sort_order": 999,
    "is_final": False,
    "is_success": False,
}

# Roles of users and severities of journal entries.
ROLES = ("sales_manager", "production_manager", "director")
SEVERITIES = ("error", "warning")

MONEY = T.DecimalType(14, 2)
#: Wide enough to see the sign of an amount before it is rounded to cents.
EXACT = T.DecimalType(38, 10)

_TYPES = {
    "text": T.StringType(),
    "money": MONEY,
    "small": T.ShortType(),
    "long": T.LongType(),
    "bool": T.BooleanType(),
    "ts": T.TimestampType(),
    "date": T.DateType(),
}


@dataclass(frozen=True)
class Table:
    """A typed table with the constraints that its rows must meet."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    #: column -> referenced table (by that table's one-column key)
    references: dict[str, str] = field(default_factory=dict)
    #: columns that must be >= 0
    not_negative: tuple[str, ...] = ()
    #: columns that must be > 0
    positive: tuple[str, ...] = ()
    #: column -> allowed values
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]

    def type_of(self, column: str) -> T.DataType:
        return self.schema[column].dataType


def _schema(spec: str) -> T.StructType:
    """``name:type`` pairs; a trailing ``!`` marks a required column."""
    fields = []
    for item in spec.split():
        name, kind = item.split(":")
        fields.append(T.StructField(name, _TYPES[kind.rstrip("!")], not kind.endswith("!")))
    return T.StructType(fields)


def _table(name: str, spec: str, key: str, **constraints) -> Table:
    return Table(name, _schema(spec), tuple(key.split()), **constraints)


_TABLES = (
    _table("sources", "source_id:text! name:text!", "source_id"),
    _table(
        "users",
        "user_id:text! name:text! role:text active:bool! department:text email:text",
        "user_id",
        domains={"role": ROLES},
    ),
    _table(
        "pipeline_stages",
        "stage_id:text! pipeline_id:text! stage_name:text! sort_order:small! is_final:bool!"
        " is_success:bool!",
        "stage_id",
    ),
    _table(
        "companies",
        "company_id:text! name:text inn:text city:text industry:text created_at:ts",
        "company_id",
    ),
    _table(
        "products",
        "product_id:text! sku:text name:text! category:text cost_price:money is_active:bool!",
        "product_id",
        not_negative=("cost_price",),
    ),
    _table(
        "contacts",
        "contact_id:text! company_id:text name:text phone:text email:text created_at:ts",
        "contact_id",
        references={"company_id": "companies"},
    ),
    _table(
        "deals",
        "deal_id:text! title:text created_at:ts! updated_at:ts stage_id:text manager_id:text"
        " company_id:text contact_id:text source_id:text expected_amount:money currency:text"
        " closed_at:ts lost_reason:text custom_deadline:date",
        "deal_id",
        references={
            "stage_id": "pipeline_stages",
            "manager_id": "users",
            "company_id": "companies",
            "contact_id": "contacts",
            "source_id": "sources",
        },
        not_negative=("expected_amount",),
    ),
    _table(
        "deal_products",
        "deal_id:text! product_id:text! quantity:small! unit_price:money! discount:money!",
        "deal_id product_id",
        references={"deal_id": "deals", "product_id": "products"},
        not_negative=("unit_price", "discount"),
        positive=("quantity",),
    ),
    # A payment may be negative: it is a correction.
    _table(
        "payments",
        "payment_id:text! deal_id:text! payment_date:date amount:money! payment_type:text"
        " status:text",
        "payment_id",
        references={"deal_id": "deals"},
    ),
    _table(
        "activities",
        "activity_id:text! deal_id:text! activity_type:text direction:text subject:text"
        " responsible_user_id:text completed:bool! deadline_at:ts completed_at:ts",
        "activity_id",
        references={"deal_id": "deals", "responsible_user_id": "users"},
    ),
    _table(
        "stage_history",
        "event_id:text! deal_id:text! old_stage_id:text new_stage_id:text changed_at:ts!"
        " changed_by_id:text",
        "event_id",
        references={
            "deal_id": "deals",
            "old_stage_id": "pipeline_stages",
            "new_stage_id": "pipeline_stages",
            "changed_by_id": "users",
        },
    ),
    _table(
        "production_orders",
        "production_order_id:text! deal_id:text! created_at:ts planned_finish_at:date"
        " actual_finish_at:date status:text workshop:text",
        "production_order_id",
        references={"deal_id": "deals"},
    ),
    _table(
        "shipments",
        "shipment_id:text! deal_id:text! planned_date:date actual_date:date status:text",
        "shipment_id",
        references={"deal_id": "deals"},
    ),
    _table(
        "marketing_costs",
        "cost_id:text! cost_date:date! source_id:text campaign:text cost_amount:money!"
        " currency:text",
        "cost_id",
        references={"source_id": "sources"},
        not_negative=("cost_amount",),
    ),
    _table(
        "rejects",
        "reject_id:text! logged_at:ts! run_id:text! severity:text! source_table:text!"
        " record_key:text rule_id:text! reason:text! raw_data:text",
        "run_id reject_id",
        domains={"severity": SEVERITIES},
    ),
)

#: In build order: every table follows the tables that it refers to.
TABLES: dict[str, Table] = {table.name: table for table in _TABLES}


def raw_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS[table]])
