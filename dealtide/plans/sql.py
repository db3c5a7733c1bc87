"""The reports and the text functions for users of Spark SQL, with their arguments.

:func:`register` makes the tables of a run available as temporary views ``main_<table>`` and the reports as
table functions: ``SELECT * FROM receivables(min_remaining => 1000)``. The functions are SQL themselves, so that Spark
puts the arguments in as literals and plans the query as a whole: conditions reach the scans, and of tables
stored by month only the months of a period are read. Results and types are those of
:mod:`dealtide.plans.reports`; the order of rows is up to the query.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from dealtide.functions.keys import LATIN
from dealtide.plans import reports
from dealtide.plans.reports import PAID, PENDING
from dealtide.sources.snapshot import MONTH, Snapshot

Tables = Mapping[str, DataFrame]

#: Tables that the functions read.
USED = (
    "deals", "pipeline_stages", "users", "deal_products", "products", "payments", "activities", "production_orders",
    "sources", "marketing_costs", "rejects",
)

_PERIOD = "from_time TIMESTAMP DEFAULT NULL, to_time TIMESTAMP DEFAULT NULL"

_PRICED = """economics AS (
    SELECT l.deal_id, sum(l.quantity * l.unit_price - l.discount) AS revenue,
           sum(l.quantity * l.unit_price - l.discount) - sum(l.quantity * p.cost_price) AS margin
    FROM main_deal_products l JOIN main_products p ON p.product_id = l.product_id
    WHERE l.deal_id IN (SELECT deal_id FROM chosen)
    GROUP BY l.deal_id)"""


def _within(column: str, by_month: bool) -> str:
    """Condition of a period, on the partitions too if the table is stored by the month of the column."""
    said = f"(from_time IS NULL OR {column} >= from_time) AND (to_time IS NULL OR {column} < to_time)"
    if by_month:
        said += (f" AND (from_time IS NULL OR {MONTH} >= date_format(from_time, 'yyyy-MM'))"
                 f" AND (to_time IS NULL OR {MONTH} <= date_format(to_time - INTERVAL 1 MICROSECOND, 'yyyy-MM'))")
    return said


def _functions(months: Mapping[str, bool]) -> dict[str, tuple[str, str]]:
    """Name -> parameters and query of each table function."""
    created = _within("created_at", months["deals"])
    spent = _within("CAST(cost_date AS TIMESTAMP)", months["marketing_costs"])
    return {
        "funnel": (_PERIOD, f"""
            SELECT s.sort_order, s.stage_id, s.stage_name, coalesce(d.n, 0), coalesce(d.amount, 0)
            FROM main_pipeline_stages s LEFT JOIN (
                SELECT stage_id, count(deal_id) AS n, sum(expected_amount) AS amount
                FROM main_deals WHERE {created} GROUP BY stage_id) d ON d.stage_id = s.stage_id"""),
        "managers": (f"{_PERIOD}, won BOOLEAN DEFAULT false", f"""
            WITH chosen AS (
                SELECT deal_id, manager_id FROM main_deals
                WHERE {created} AND manager_id IS NOT NULL
                  AND (NOT won OR stage_id IN (SELECT stage_id FROM main_pipeline_stages WHERE is_success))
            ), {_PRICED}
            SELECT u.user_id, u.name, m.n, coalesce(m.revenue, 0), coalesce(m.margin, 0),
                   round(coalesce(CAST(m.margin AS DECIMAL(28, 2)), 0) * 100
                         / nullif(CAST(m.revenue AS DECIMAL(28, 2)), CAST(0 AS DECIMAL(28, 2))), 1)
            FROM main_users u JOIN (
                SELECT c.manager_id, count(*) AS n, sum(e.revenue) AS revenue, sum(e.margin) AS margin
                FROM chosen c LEFT JOIN economics e ON e.deal_id = c.deal_id GROUP BY c.manager_id
            ) m ON m.manager_id = u.user_id"""),
        "receivables": ("min_remaining DECIMAL(14, 2) DEFAULT NULL", f"""
            WITH sums AS (
                SELECT deal_id, sum(amount) FILTER (WHERE status = '{PAID}') AS paid,
                       sum(amount) FILTER (WHERE status = '{PENDING}') AS pending
                FROM main_payments GROUP BY deal_id
            ), owed AS (
                SELECT d.deal_id, d.stage_id, d.expected_amount, coalesce(s.paid, 0) AS paid,
                       coalesce(s.pending, 0) AS pending, coalesce(d.expected_amount, 0) - coalesce(s.paid, 0) AS remaining
                FROM main_deals d LEFT JOIN sums s ON s.deal_id = d.deal_id
                WHERE d.expected_amount IS NOT NULL OR s.deal_id IS NOT NULL)
            SELECT * FROM owed WHERE min_remaining IS NULL OR remaining >= min_remaining"""),
        "production_delays": ("as_of DATE DEFAULT current_date(), days INT DEFAULT 5", """
            SELECT production_order_id, deal_id, workshop, status, planned_finish_at, actual_finish_at,
                   datediff(coalesce(actual_finish_at, as_of), planned_finish_at)
            FROM main_production_orders
            WHERE datediff(coalesce(actual_finish_at, as_of), planned_finish_at) > days"""),
        "stale_deals": ("as_of DATE DEFAULT current_date(), days INT DEFAULT 7", """
            SELECT d.deal_id, d.stage_id, d.manager_id, a.last_at
            FROM main_deals d LEFT JOIN (
                SELECT deal_id, max(coalesce(completed_at, deadline_at)) AS last_at FROM main_activities GROUP BY deal_id
            ) a ON a.deal_id = d.deal_id
            WHERE d.stage_id IN (SELECT stage_id FROM main_pipeline_stages WHERE NOT is_final)
              AND (a.last_at IS NULL OR a.last_at < CAST(date_sub(as_of, days) AS TIMESTAMP))"""),
        "lead_sources": (_PERIOD, f"""
            WITH chosen AS (
                SELECT deal_id, source_id FROM main_deals WHERE {created} AND source_id IS NOT NULL
            ), {_PRICED}, sold AS (
                SELECT c.source_id, count(*) AS n, sum(e.revenue) AS revenue, sum(e.margin) AS margin
                FROM chosen c LEFT JOIN economics e ON e.deal_id = c.deal_id GROUP BY c.source_id
            ), spent AS (
                SELECT source_id, sum(cost_amount) AS cost FROM main_marketing_costs WHERE {spent} GROUP BY source_id
            ), both AS (
                SELECT s.source_id, s.name, coalesce(d.n, 0) AS n, coalesce(d.revenue, 0) AS revenue,
                       CAST(coalesce(d.margin, 0) AS DECIMAL(28, 2)) AS margin, CAST(coalesce(c.cost, 0) AS DECIMAL(28, 2)) AS cost
                FROM main_sources s LEFT JOIN sold d ON d.source_id = s.source_id LEFT JOIN spent c ON c.source_id = s.source_id)
            SELECT source_id, name, n, revenue, margin, cost, margin - cost,
                   round(CAST(margin - cost AS DECIMAL(28, 2)) / nullif(cost, CAST(0 AS DECIMAL(28, 2))), 4) FROM both"""),
        "defects": ("of_severity STRING DEFAULT NULL, of_run STRING DEFAULT NULL", """
            SELECT severity, source_table, count(*) FROM main_rejects
            WHERE (of_severity IS NULL OR severity = of_severity) AND (of_run IS NULL OR run_id = of_run)
            GROUP BY severity, source_table"""),
    }


def _results(tables: Tables) -> dict[str, DataFrame]:
    """The reports whose columns and types the functions have."""
    return {
        "funnel": reports.funnel(tables),
        "managers": reports.managers(tables),
        "receivables": reports.receivables(tables),
        "production_delays": reports.production_delays(tables),
        "stale_deals": reports.stale_deals(tables),
        "lead_sources": reports.lead_sources(tables, with_romi=True),
        "defects": reports.defect_summary(tables),
    }


def register(spark: SparkSession, tables: Tables) -> list[str]:
    """Views ``main_<table>`` and the table functions on them; returns the names of the functions.

    All are temporary: they belong to the session. Registering another run replaces them.
    """
    months = {}
    for table in USED:
        stored = tables.stored(table) if isinstance(tables, Snapshot) else tables[table]
        months[table] = MONTH in stored.columns
        stored.createOrReplaceTempView(f"main_{table}")
    functions, results = _functions(months), _results(tables)
    for name, (parameters, query) in functions.items():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in results[name].schema.fields)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE ({columns}) RETURN {query}")
    return list(functions)


def _translit(text: str) -> str:
    single = {letter: latin for letter, latin in LATIN.items() if len(latin) == 1}
    silent = [letter for letter, latin in LATIN.items() if not latin]
    said = f"translate(lower(coalesce({text}, '')), '{''.join([*single, *silent])}', '{''.join(single.values())}')"
    for letter, latin in LATIN.items():
        if len(latin) > 1:
            said = f"replace({said}, '{letter}', '{latin}')"
    return said


def register_text_functions(spark: SparkSession) -> list[str]:
    """``translit(text)`` and ``source_key(text)`` as SQL functions: see :mod:`dealtide.functions.keys`."""
    key = f"nullif(btrim(regexp_replace({_translit('text')}, '[^a-z0-9]+', '_'), '_'), '')"
    bodies = {"translit": _translit("text"), "source_key": key}
    for name, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(text STRING) RETURNS STRING RETURN {body}")
    return list(bodies)


__all__ = ["USED", "register", "register_text_functions"]
