"""The registered queries: every operator of the package on whole test tables.

Results leave as plain types (text, double, bigint, boolean), so that they can be compared.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealtide.catalog.feed import awkward_field, base, broken_feed, main_feed, raw_feed
from dealtide.functions import local_date, parse_date, parse_ts, source_key
from dealtide.model import RAW_COLUMNS, TABLES
from dealtide.operators import expectations
from dealtide.operators.duplicates import keep_first, mark_duplicates
from dealtide.operators.findings import entries, journal
from dealtide.operators.references import (
    mark_known, mark_known_by_exceptions, parent_keys,
)
from dealtide.operators.unions import union_all
from dealtide.plans import quality, reports, sql
from dealtide.plans.cleaning import Options
from dealtide.plans.refresh import JOBS_AT_ONCE, Cleaned, refresh
from dealtide.session import path_bytes, prepare, shared_folder, store, stored_until_done
from dealtide.sources.exports import read_raw
from dealtide.sources.snapshot import (
    SnapshotWriter, append_journal, compare_runs, read_journal, read_manifest, read_snapshot,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

AS_OF_DELAYS = "2001-12-01"
AS_OF_EVENTS = "2024-02-07"
PERIOD = ("1997-01-01", "1999-01-01")
#: A total over each view.
VIEW_TOTALS = {
    "v_funnel": "sum(CAST(amount_total AS DECIMAL(18, 2)))",
    "v_managers": "sum(CAST(revenue AS DECIMAL(18, 2)))",
    "v_receivables": "sum(CAST(remaining AS DECIMAL(18, 2)))",
    "v_production_delays": "sum(delay_days)",
    "v_stale_deals": "count(last_activity_at)",
    "v_sources": "sum(CAST(net AS DECIMAL(18, 2)))",
    "v_data_quality": "sum(cnt)",
    "v_data_quality_detail": "sum(length(reason))",
}


def plain(df: DataFrame) -> DataFrame:
    """Amounts as double, small integers as bigint, dates and instants as text."""
    def column(field: T.StructField):
        c = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, (T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DateType):
            c = c.cast("string")
        return c.alias(field.name)

    return df.select(*[column(f) for f in df.schema.fields])


def query(run: Query) -> Query:
    """Register a query under the name of its function."""
    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(run(prepare(spark), sf_dir))

    prepared.__doc__ = run.__doc__
    QUERIES[run.__name__] = prepared
    return run


# ---- expressions --------------------------------------------------------------------------


@query
def clean_parse_ts(spark, sf_dir):
    """Order dates written in five ways, one of which is no date."""
    d = F.col("o_orderdate")
    text = (
        F.when(F.col("o_orderpriority") == "1-URGENT",
               F.concat(F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:00")))
        .when(F.col("o_orderpriority") == "2-HIGH", F.date_format(d, "dd.MM.yyyy HH:mm"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.date_format(d, " yyyy/MM/dd "))
        .when(F.col("o_orderpriority") == "5-LOW", F.date_format(d, "MMM yyyy"))
        .otherwise(F.date_format(d, "dd.MM.yyyy"))
    )
    return base(spark, sf_dir, "orders").select(
        "o_orderkey", parse_ts(text).alias("parsed"), parse_date(text).alias("parsed_date")
    )


@query
def clean_parse_events(spark, sf_dir):
    """Event times without an offset, read in a zone of their own, and with one."""
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    zoned = F.concat(text, F.lit(" -03:30"))
    return base(spark, sf_dir, "events").select(
        "event_id",
        parse_ts(text, naive_tz="+05:00").alias("local_time"),
        parse_ts(zoned).alias("zoned_time"),
    )


@query
def clean_parse_zones(spark, sf_dir):
    """Order dates with zones in words and numbers, without seconds, and with unknown zones."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    spelled = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(day, F.lit(" 23:30:10 EST")))
        .when(F.col("o_orderpriority") == "2-HIGH", F.concat(day, F.lit("T01:15+05")))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(day, F.lit(" 01:15 msk")))
        .when(F.col("o_orderpriority") == "5-LOW", F.concat(day, F.lit(" 01:15:00 GMT+3")))
        .otherwise(F.concat(day, F.lit(" 1:15")))
    )
    return base(spark, sf_dir, "orders").select(
        "o_orderkey",
        parse_ts(spelled, naive_tz="+05:00").alias("parsed"),
        parse_date(spelled).alias("parsed_date"),
        local_date(parse_ts(spelled, naive_tz="+05:00"), "+05:00").alias("local_day"),
    )


def _spellings(spark, sf_dir):
    """Names, texts of any length, and Cyrillic spellings."""
    customer = base(spark, sf_dir, "customer")
    latin, cyrillic = "abvgdzijklmnoprstufhcye", "абвгдзийклмнопрстуфхцыэ"
    spelled = F.translate(F.lower("c_mktsegment"), latin, cyrillic)
    documents = base(spark, sf_dir, "documents")
    rows = [
        customer.select(F.concat(F.lit("name "), F.col("c_custkey").cast("string")).alias("row_id"),
                        F.col("c_name").alias("spelling")),
        customer.select(
            F.concat(F.lit("segment "), F.col("c_custkey").cast("string")).alias("row_id"),
            F.concat(F.lit("  "), spelled, F.lit(" / 1-й")).alias("spelling")),
        documents.select(
            F.concat(F.lit("document "), F.col("doc_id").cast("string")).alias("row_id"),
            F.col("text").alias("spelling")),
    ]
    return union_all(rows)


@query
def clean_source_key(spark, sf_dir):
    """Source keys of names, of texts of any length, and of Cyrillic spellings."""
    return _spellings(spark, sf_dir).select("row_id", source_key(F.col("spelling")).alias("source_key"))


# ---- cleaning, one query per table --------------------------------------------------------


def _cleaned(spark, sf_dir) -> Cleaned:
    return Cleaned(raw_feed(spark, sf_dir))


@query
def clean_sources_dim(spark, sf_dir):
    return _cleaned(spark, sf_dir)["sources"]


@query
def clean_users(spark, sf_dir):
    return _cleaned(spark, sf_dir)["users"]


@query
def clean_stages(spark, sf_dir):
    """The stage dimension with its service stage, and how many raw deals name each stage."""
    cleaned = _cleaned(spark, sf_dir)
    named = cleaned.raw["deals"].groupBy("stage_id").agg(F.count("*").alias("raw_deals"))
    return cleaned["pipeline_stages"].join(named, "stage_id", "left").drop("stage_name").withColumn(
        "raw_deals", F.coalesce("raw_deals", F.lit(0))
    )


@query
def clean_unknown_stage(spark, sf_dir):
    """Cleaned deals by stage; unknown stages have become UNKNOWN."""
    deals = _cleaned(spark, sf_dir)["deals"]
    return deals.groupBy("stage_id").agg(
        F.count("*").alias("deals_count"), F.sum("expected_amount").alias("amount_total")
    )


@query
def clean_companies(spark, sf_dir):
    return _cleaned(spark, sf_dir)["companies"]


@query
def clean_products(spark, sf_dir):
    return _cleaned(spark, sf_dir)["products"]


@query
def clean_contacts(spark, sf_dir):
    return _cleaned(spark, sf_dir)["contacts"]


@query
def clean_deals(spark, sf_dir):
    return _cleaned(spark, sf_dir)["deals"]


@query
def clean_deal_products(spark, sf_dir):
    return _cleaned(spark, sf_dir)["deal_products"]


@query
def clean_payments(spark, sf_dir):
    return _cleaned(spark, sf_dir)["payments"]


@query
def clean_activities(spark, sf_dir):
    return _cleaned(spark, sf_dir)["activities"]


@query
def clean_stage_history(spark, sf_dir):
    return _cleaned(spark, sf_dir)["stage_history"]


@query
def clean_production_orders(spark, sf_dir):
    return _cleaned(spark, sf_dir)["production_orders"]


@query
def clean_shipments(spark, sf_dir):
    return _cleaned(spark, sf_dir)["shipments"]


@query
def clean_marketing_costs(spark, sf_dir):
    """Costs without their generated id, which no other system can compute."""
    return _cleaned(spark, sf_dir)["marketing_costs"].drop("cost_id")


@query
def clean_cost_ids(spark, sf_dir):
    """Generated ids are distinct, also those of rows with the same content."""
    return _cleaned(spark, sf_dir)["marketing_costs"].groupBy("source_id").agg(
        F.count("cost_id").alias("cost_rows"), F.countDistinct("cost_id").alias("cost_ids")
    )


@query
def clean_payments_local(spark, sf_dir):
    """Payments whose dates are read in a zone of their own: the written day stays."""
    options = Options(naive_tz="+05:00")
    payments = Cleaned(raw_feed(spark, sf_dir), options)["payments"]
    return payments.select("payment_id", "deal_id", "payment_date")


@query
def clean_quarantined_casts(spark, sf_dir):
    """Production orders of which some have text behind a date: dropped and journalled."""
    raw = raw_feed(spark, sf_dir)
    orders = raw["production_orders"]
    planned = F.col("planned_finish_at")
    raw["production_orders"] = orders.withColumn(
        "planned_finish_at",
        F.when(F.col("workshop") == "Workshop 2", F.concat(planned, F.lit(" garbage")))
        .when(F.col("workshop") == "Workshop 3", F.concat(planned, F.lit("T25:99")))
        .otherwise(planned),
    )
    cleaned = Cleaned(raw, Options(on_cast_error="quarantine"))
    stay = cleaned["production_orders"].groupBy(F.col("workshop").alias("name"))
    found = cleaned.entries("production_orders").groupBy(F.col("rule_id").alias("name"))
    return stay.agg(F.count("*").alias("row_count")).unionByName(
        found.agg(F.count("*").alias("row_count"))
    )


# ---- operators on the tables as they are --------------------------------------------------


def _latest_shipment():
    return [F.col("l_shipdate").desc_nulls_last()]


@query
def clean_dedupe_lines(spark, sf_dir):
    """The latest of the lines with the same order and number."""
    lines = base(spark, sf_dir, "lineitem")
    return keep_first(lines, ["l_orderkey", "l_linenumber"], _latest_shipment())


@query
def clean_duplicate_lines(spark, sf_dir):
    """The lines that :func:`clean_dedupe_lines` leaves out."""
    lines = base(spark, sf_dir, "lineitem")
    marked = mark_duplicates(lines, ["l_orderkey", "l_linenumber"], _latest_shipment())
    return marked.filter("_duplicate").drop("_duplicate")


@query
def clean_dedupe_sku(spark, sf_dir):
    """One part per name and brand: parts in returned lines first, then the smallest key."""
    parts = base(spark, sf_dir, "part").withColumn("sku", F.concat("p_name", F.lit("|"), "p_brand"))
    returned = base(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'")
    parts = mark_known(parts, "p_partkey", parent_keys(returned, "l_partkey"), "referenced")
    first = [F.col("referenced").desc(), F.col("p_partkey").asc()]
    return keep_first(parts, ["sku"], first).select("p_partkey", "sku", "referenced")


@query
def clean_orphans(spark, sf_dir):
    """Lines whose order or part is not among those accepted: number and value by reason."""
    orders = base(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'")
    parts = base(spark, sf_dir, "part").filter("p_size <= 25")
    lines = base(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    lines = mark_known(lines, "l_orderkey", orders.select("o_orderkey"), "has_order")
    lines = mark_known(lines, "l_partkey", parts.select("p_partkey"), "has_part")
    return lines.groupBy("has_order", "has_part").agg(
        F.count("*").alias("line_count"),
        F.sum(F.col("l_extendedprice").cast("decimal(14,2)")).alias("line_value"),
    )


@query
def clean_orphans_by_exceptions(spark, sf_dir):
    """The same, looking up the orders and parts without a row first."""
    orders = base(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'")
    parts = base(spark, sf_dir, "part").filter("p_size <= 25")
    lines = base(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    for column, keys, flag in (
        ("l_orderkey", parent_keys(orders, "o_orderkey"), "has_order"),
        ("l_partkey", parent_keys(parts, "p_partkey"), "has_part"),
    ):
        lines = mark_known_by_exceptions(lines, column, keys, flag)
    return lines.groupBy("has_order", "has_part").agg(
        F.count("*").alias("line_count"),
        F.sum(F.col("l_extendedprice").cast("decimal(14,2)")).alias("line_value"),
    )


@query
def clean_negative_amount(spark, sf_dir):
    """Deals whose negative amount was set to NULL, with all that was found on them."""
    rows = _cleaned(spark, sf_dir).annotated("deals")
    negative = F.exists("_findings", lambda f: f["rule_id"] == "AMOUNT_NEGATIVE")
    return rows.filter(negative).select(
        "deal_id", "expected_amount",
        F.array_join(F.transform("_findings", lambda f: f["rule_id"]), ",").alias("found"),
        F.get_json_object("_source_row", "$.expected_amount").alias("raw_amount"),
    )


# ---- journal ------------------------------------------------------------------------------

JOURNALLED = (
    "companies", "products", "contacts", "deals", "deal_products", "payments", "activities",
    "stage_history", "production_orders", "shipments",
)


def _journal_tables(spark, sf_dir, *tables):
    return {"rejects": _cleaned(spark, sf_dir).entries(*tables)}


def _stored_journal(spark, found):
    """The journal of some entries, stored; the entries as well until it is, since the ids read them several times."""
    path = f"{shared_folder(spark)}/dealtide-tables/{uuid.uuid4().hex}"
    with stored_until_done(spark):
        log = journal(store(found)[0], "run")
        log.write.parquet(path)
    return spark.read.schema(log.schema).parquet(path)


@query
def journal_summary(spark, sf_dir):
    """Defects of all raw tables by severity and table."""
    return reports.defect_summary(_journal_tables(spark, sf_dir, *JOURNALLED))


@query
def journal_rules(spark, sf_dir):
    """Defects of all raw tables by table and rule."""
    found = _cleaned(spark, sf_dir).entries(*JOURNALLED)
    return found.groupBy("source_table", "rule_id").agg(F.count("*").alias("cnt"))


@query
def journal_detail(spark, sf_dir):
    """Defects of all raw tables, one by one, with their source row."""
    found = _cleaned(spark, sf_dir).entries(*JOURNALLED)
    return found.select("severity", "source_table", "record_key", "rule_id", "reason", "raw_data")


@query
def journal_errors(spark, sf_dir):
    """Only the errors: the rows of all raw tables that were dropped for one."""
    tables = _journal_tables(spark, sf_dir, *JOURNALLED)
    return reports.defect_detail(tables, severity="error")


@query
def journal_ids(spark, sf_dir):
    """Journal ids are distinct, also those of equal entries."""
    # Stored: the ids read the entries several times.
    found, _ = store(_cleaned(spark, sf_dir).entries(*JOURNALLED))
    log = journal(found, "run")
    return log.groupBy("source_table", "rule_id").agg(
        F.count("*").alias("entry_count"), F.countDistinct("reject_id").alias("id_count")
    )


@query
def journal_runs(spark, sf_dir):
    """The journal of two runs, of which one is added twice: each counts once."""
    cleaned = _cleaned(spark, sf_dir)
    folder = f"{shared_folder(spark)}/journals/{uuid.uuid4().hex}"
    for run_id, tables in (("one", ["deals"]), ("two", ["payments", "products"]), ("one", ["payments", "contacts"])):
        append_journal(store(journal(cleaned.entries(*tables), run_id))[0], folder, run_id)
    log = {"rejects": read_journal(spark, folder)}
    return union_all([
        reports.defect_summary(log, run_id=run_id).withColumn("run_id", F.lit(run_id)) for run_id in ("one", "two")
    ])


@query
def journal_fields(spark, sf_dir):
    """The deals and statuses in the source rows of a stored journal, read from their VARIANT."""
    folder = f"{shared_folder(spark)}/journals/{uuid.uuid4().hex}"
    append_journal(_stored_journal(spark, _cleaned(spark, sf_dir).entries(*JOURNALLED)), folder, "run")
    log = read_journal(spark, folder, {"deal": "deal_id", "status": "status"})
    return log.filter("deal IS NOT NULL").groupBy("source_table", "rule_id", "status").agg(
        F.count("*").alias("cnt"), F.countDistinct("deal").alias("deals")
    )


# ---- expectations -------------------------------------------------------------------------


@query
def expect_checks(spark, sf_dir):
    """Broken constraints of the typed tables, one row per constraint."""
    return expectations.check(broken_feed(spark, sf_dir).load_all())


@query
def expect_written(spark, sf_dir):
    """The same, of tables whose rows were checked while they were written."""
    tables = broken_feed(spark, sf_dir).load_all()
    out = SnapshotWriter(spark, f"{shared_folder(spark)}/snapshots", uuid.uuid4().hex)
    for table in tables:
        out.write("main", table, tables[table])
    return expectations.check(out.tables)


@query
def expect_unique_violations(spark, sf_dir):
    """The deal lines that share their key with another line."""
    tables = main_feed(spark, sf_dir)
    lines = tables["deal_products"]
    return expectations.violations(lines, "deal_products", "UNIQUE", "deal_id,product_id", tables)


@query
def expect_reference_violations(spark, sf_dir):
    """Payments of deals that do not exist."""
    tables = main_feed(spark, sf_dir)
    payments = tables["payments"]
    return expectations.violations(payments, "payments", "REFERENCE", "deal_id", tables)


@query
def expect_quarantine(spark, sf_dir):
    """Findings that dropped rows of all broken tables, by rule, and the rows that stay."""
    # Stored: each is read several times, by its own checks and as the parent of others.
    given = broken_feed(spark, sf_dir).load_all()
    with ThreadPoolExecutor(JOBS_AT_ONCE) as jobs:
        tables = dict(zip(given, jobs.map(lambda table: store(table)[0], given.values())))
        checked = list(jobs.map(lambda name: store(expectations.quarantine(tables[name], name, tables))[0], tables))
    counts = []
    for name, rows in zip(tables, checked):
        stay = rows.filter("NOT _dropped").withColumn("rule_id", F.lit("stays"))
        for found in (entries(rows, name).select("rule_id"), stay.select("rule_id")):
            counts.append(found.groupBy(F.lit(name).alias("table_name"), "rule_id").agg(
                F.count("*").alias("row_count")
            ))
    return union_all(counts)


# ---- reports ------------------------------------------------------------------------------


@query
def report_economics(spark, sf_dir):
    return reports.deal_economics(main_feed(spark, sf_dir))


@query
def report_funnel(spark, sf_dir):
    return reports.funnel(main_feed(spark, sf_dir)).drop("stage_name")


@query
def report_funnel_period(spark, sf_dir):
    return reports.funnel(main_feed(spark, sf_dir), *PERIOD).drop("stage_name")


@query
def report_managers(spark, sf_dir):
    return reports.managers(main_feed(spark, sf_dir))


@query
def report_managers_won(spark, sf_dir):
    return reports.managers(main_feed(spark, sf_dir), *PERIOD, won=True)


@query
def report_managers_unassigned(spark, sf_dir):
    return reports.managers(main_feed(spark, sf_dir), include_unassigned=True)


@query
def report_receivables(spark, sf_dir):
    return reports.receivables(main_feed(spark, sf_dir))


@query
def report_receivables_min(spark, sf_dir):
    return reports.receivables(main_feed(spark, sf_dir), min_remaining="250000.00")


@query
def report_receivables_unlinked(spark, sf_dir):
    """Receivables with the payments that the cleaning found no deal for."""
    cleaned = _cleaned(spark, sf_dir)
    tables = {
        "deals": main_feed(spark, sf_dir)["deals"],
        "payments": cleaned["payments"],
        "rejects": cleaned.entries("payments"),
    }
    return reports.receivables(tables, include_unlinked=True)


@query
def report_delays(spark, sf_dir):
    return reports.production_delays(main_feed(spark, sf_dir), AS_OF_DELAYS)


@query
def report_delays_long(spark, sf_dir):
    return reports.production_delays(main_feed(spark, sf_dir), AS_OF_DELAYS, days=365)


@query
def report_stale(spark, sf_dir):
    return reports.stale_deals(main_feed(spark, sf_dir), AS_OF_EVENTS)


@query
def report_stale_2days(spark, sf_dir):
    return reports.stale_deals(main_feed(spark, sf_dir), AS_OF_EVENTS, days=2)


@query
def report_sources(spark, sf_dir):
    return reports.lead_sources(main_feed(spark, sf_dir))


@query
def report_sources_romi(spark, sf_dir):
    return reports.lead_sources(main_feed(spark, sf_dir), *PERIOD, with_romi=True)


@query
def report_cleaned_managers(spark, sf_dir):
    """From raw exports to the managers report."""
    return reports.managers(_cleaned(spark, sf_dir))


@query
def report_cleaned_sources(spark, sf_dir):
    """From raw exports to the report by lead source."""
    return reports.lead_sources(_cleaned(spark, sf_dir))


@query
def report_views(spark, sf_dir):
    """Rows and a total of each of the eight views, with the journal of all raw tables."""
    tables = main_feed(spark, sf_dir)
    tables["rejects"] = _stored_journal(spark, _cleaned(spark, sf_dir).entries(*JOURNALLED))
    reports.register_views(spark, tables, AS_OF_EVENTS)
    return spark.sql(" UNION ALL ".join(
        f"SELECT '{view}' AS view_name, count(*) AS row_count, CAST({total} AS DOUBLE) AS total FROM {view}"
        for view, total in VIEW_TOTALS.items()
    ))


def _stored(spark, sf_dir, *names):
    """Typed tables written as a snapshot and read back."""
    tables = main_feed(spark, sf_dir)
    out = SnapshotWriter(spark, f"{shared_folder(spark)}/snapshots", uuid.uuid4().hex)
    for table in names:
        out.write("main", table, tables[table])
    out.finish()
    return read_snapshot(spark, out.folder)


@query
def stored_funnel_period(spark, sf_dir):
    """The funnel of a period from stored tables: only the months of the period are read."""
    return reports.funnel(_stored(spark, sf_dir, "deals", "pipeline_stages"), *PERIOD).drop("stage_name")


@query
def stored_managers_won(spark, sf_dir):
    names = ("deals", "pipeline_stages", "users", "deal_products", "products")
    return reports.managers(_stored(spark, sf_dir, *names), *PERIOD, won=True)


@query
def stored_sources_romi(spark, sf_dir):
    names = ("sources", "deals", "deal_products", "products", "marketing_costs")
    return reports.lead_sources(_stored(spark, sf_dir, *names), *PERIOD, with_romi=True)


def _bucketed(spark, sf_dir, feed, *names):
    """Typed tables written in buckets by deal, as many as the lines ask for, and read back."""
    out = SnapshotWriter(spark, f"{shared_folder(spark)}/snapshots", uuid.uuid4().hex)
    out.use_buckets(path_bytes(spark, f"{sf_dir}/lineitem.parquet"), least=2)
    for table in names:
        out.write("main", table, feed[table])
    out.finish()
    return read_snapshot(spark, out.folder)


@query
def stored_economics(spark, sf_dir):
    """Revenue and cost of each deal from stored lines: grouped without a shuffle."""
    return reports.deal_economics(_bucketed(spark, sf_dir, main_feed(spark, sf_dir), "deal_products", "products"))


@query
def stored_receivables(spark, sf_dir):
    """Receivables from stored deals and payments: joined bucket by bucket."""
    return reports.receivables(_bucketed(spark, sf_dir, main_feed(spark, sf_dir), "deals", "payments"))


@query
def stored_stale(spark, sf_dir):
    names = ("deals", "activities", "pipeline_stages")
    return reports.stale_deals(_bucketed(spark, sf_dir, main_feed(spark, sf_dir), *names), AS_OF_EVENTS)


@query
def stored_checks(spark, sf_dir):
    """Broken constraints of stored tables: children of deals are held against their bucket of deals."""
    feed = broken_feed(spark, sf_dir).load_all()
    return expectations.check(_bucketed(spark, sf_dir, feed, *feed))


def _sql(spark, sf_dir, query, *journalled):
    """A query on the table functions, over typed tables and the journal of some raw tables."""
    tables = main_feed(spark, sf_dir)
    found = _cleaned(spark, sf_dir).entries(*journalled) if journalled else None
    tables["rejects"] = _stored_journal(spark, found) if found else spark.createDataFrame([], TABLES["rejects"].schema)
    sql.register(spark, tables)
    return spark.sql(query)


_SQL_PERIOD = f"timestamp'{PERIOD[0]}', timestamp'{PERIOD[1]}'"


@query
def sql_funnel(spark, sf_dir):
    return _sql(spark, sf_dir, f"SELECT * EXCEPT (stage_name) FROM funnel({_SQL_PERIOD})")


@query
def sql_managers(spark, sf_dir):
    return _sql(spark, sf_dir, f"SELECT * FROM managers({_SQL_PERIOD}, won => true)")


@query
def sql_receivables(spark, sf_dir):
    return _sql(spark, sf_dir, "SELECT * FROM receivables(min_remaining => 250000)")


@query
def sql_delays(spark, sf_dir):
    return _sql(spark, sf_dir, f"SELECT * FROM production_delays(date'{AS_OF_DELAYS}', 365)")


@query
def sql_stale(spark, sf_dir):
    return _sql(spark, sf_dir, f"SELECT * FROM stale_deals(date'{AS_OF_EVENTS}', days => 2)")


@query
def sql_sources(spark, sf_dir):
    return _sql(spark, sf_dir, f"SELECT * FROM lead_sources({_SQL_PERIOD})")


@query
def sql_defects(spark, sf_dir):
    return _sql(spark, sf_dir, "SELECT * FROM defects() UNION ALL SELECT * FROM defects('error')", *JOURNALLED)


@query
def sql_source_key(spark, sf_dir):
    """The same keys by the SQL function."""
    sql.register_text_functions(spark)
    _spellings(spark, sf_dir).createOrReplaceTempView("spellings")
    return spark.sql("SELECT row_id, source_key(spelling) AS source_key FROM spellings")


# ---- quality ------------------------------------------------------------------------------


@query
def quality_phones(spark, sf_dir):
    contacts = quality.standard_phones(main_feed(spark, sf_dir)["contacts"])
    return contacts.select("contact_id", "phone")


@query
def quality_currency(spark, sf_dir):
    deals = quality.default_currency(main_feed(spark, sf_dir)["deals"])
    return deals.select("deal_id", "currency", "currency_assumed")


@query
def quality_payment_types(spark, sf_dir):
    payments = quality.standard_payment_types(main_feed(spark, sf_dir)["payments"])
    return payments.select("payment_id", "payment_type")


@query
def quality_overpaid(spark, sf_dir):
    return quality.overpaid(reports.receivables(main_feed(spark, sf_dir))).filter("overpaid")


@query
def quality_negative_payments(spark, sf_dir):
    return quality.negative_payments(main_feed(spark, sf_dir))


@query
def quality_dates(spark, sf_dir):
    return quality.facts_after_close(main_feed(spark, sf_dir))


@query
def quality_overdue(spark, sf_dir):
    return quality.overdue(main_feed(spark, sf_dir), AS_OF_DELAYS)


@query
def quality_final_without_close(spark, sf_dir):
    return quality.final_without_close(main_feed(spark, sf_dir)).select("deal_id", "stage_id")


@query
def quality_lost_without_reason(spark, sf_dir):
    return quality.lost_without_reason(main_feed(spark, sf_dir)).select("deal_id", "stage_id")


@query
def quality_unused_companies(spark, sf_dir):
    return quality.unused_empty_companies(main_feed(spark, sf_dir)).select("company_id", "city")


@query
def quality_transitions(spark, sf_dir):
    return quality.transitions(main_feed(spark, sf_dir)).groupBy(
        "old_stage_id", "new_stage_id", "verdict"
    ).agg(F.count("*").alias("changes"))


@query
def quality_illegal_transitions(spark, sf_dir):
    return quality.illegal_transitions(main_feed(spark, sf_dir)).select(
        "event_id", "deal_id", "verdict"
    )


@query
def quality_skipped_stages(spark, sf_dir):
    return quality.skipped_stages(main_feed(spark, sf_dir)).select(
        "event_id", "deal_id", "skipped_stages"
    )


@query
def quality_history_gaps(spark, sf_dir):
    return quality.history_gaps(main_feed(spark, sf_dir))


# ---- sources and sinks --------------------------------------------------------------------


@query
def scan_exports(spark, sf_dir):
    """All raw tables written as CSV files and read back: with commas, quotes and line breaks inside
    fields, and with both kinds of empty fields."""
    raw = raw_feed(spark, sf_dir).load_all()
    folder = f"{shared_folder(spark)}/exports/{uuid.uuid4().hex}"
    rows = []
    for table in raw:
        path = f"{folder}/{table}.csv"
        last = RAW_COLUMNS[table][-1]
        written = raw[table].withColumn(last, F.expr(awkward_field(table)))
        writer = written.write.option("header", True).option("escape", '"')
        writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        # Compressed as fast as it goes: the text is many times the size of the tables. A file is a task here anyway.
        writer = writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
        writer.option("emptyValue", '""').csv(path)
        read = read_raw(spark, path, table, multiline=True)
        values = F.concat_ws("|", *[F.coalesce(c, F.lit("NULL")) for c in read.columns])
        rows.append(read.select(F.lit(table).alias("table_name"), values.alias("row_values")))
    return union_all(rows)


@query
def snapshot_manifest(spark, sf_dir):
    """All typed tables written as a snapshot: counts of manifest and of tables."""
    tables = main_feed(spark, sf_dir).load_all()
    out = SnapshotWriter(spark, f"{shared_folder(spark)}/snapshots", uuid.uuid4().hex)
    for table in tables:
        out.write("main", table, tables[table])
    out.finish()
    stored = read_snapshot(spark, out.folder)
    counts = union_all(
        [df.agg(F.count("*").alias("stored_rows")).withColumn("table_name", F.lit(t))
         for t, df in stored.items()]
    )
    return read_manifest(spark, out.folder).join(counts, "table_name").select(
        "table_name", "row_count", "stored_rows"
    )


@query
def refresh_manifest(spark, sf_dir):
    """The full refresh of all raw tables, with quarantine: rows of every stored table."""
    raw = raw_feed(spark, sf_dir).load_all()
    folder = f"{shared_folder(spark)}/runs"
    run = refresh(spark, raw, folder, constraints="quarantine")
    return read_manifest(spark, run).select("layer", "table_name", "row_count")


#: Tables of a refresh: what a row is called, and the amount that is summed up. Generated ids cannot be
#: named in SQL; of lines with the same key the checks keep one.
REFRESHED = {
    "sources": ("source_id", None), "users": ("user_id", None), "pipeline_stages": ("stage_id", None),
    "companies": ("company_id", None), "products": ("product_id", "cost_price"), "contacts": ("contact_id", None),
    "marketing_costs": ("source_id", "cost_amount"), "deals": ("deal_id", "expected_amount"),
    "deal_products": ("deal_id || '/' || product_id", None), "payments": ("payment_id", "amount"),
    "activities": ("activity_id", None), "stage_history": ("event_id", None),
    "production_orders": ("production_order_id", None), "shipments": ("shipment_id", None),
}


@query
def refresh_tables(spark, sf_dir):
    """Keys and amounts of all tables of a full refresh, read back and held against the manifest."""
    raw = raw_feed(spark, sf_dir).load_all()
    run = refresh(spark, raw, f"{shared_folder(spark)}/runs", constraints="quarantine")
    tables = read_snapshot(spark, run, verify=True)
    return union_all([
        tables[table].agg(
            F.count("*").alias("row_count"),
            F.expr(f"sum(CAST(conv(substr(md5({key}), 1, 8), 16, 10) AS BIGINT))").alias("key_sum"),
            F.expr(f"CAST({f'sum({amount})' if amount else 'NULL'} AS DOUBLE)").alias("amount_sum"),
        ).withColumn("table_name", F.lit(table))
        for table, (key, amount) in REFRESHED.items()
    ])


@query
def snapshot_changes(spark, sf_dir):
    """What differs between two snapshots, by their manifests: values of deals, rows of payments."""
    tables, folders = main_feed(spark, sf_dir), []
    changed = {
        "users": tables["users"].repartition(3),
        "deals": tables["deals"].withColumn("expected_amount", F.round(F.col("expected_amount"), 0).cast("decimal(14,2)")),
        "payments": tables["payments"].filter(F.col("status") == "paid"),
    }
    for given in (tables, changed):
        out = SnapshotWriter(spark, f"{shared_folder(spark)}/snapshots", uuid.uuid4().hex)
        for table in changed:
            out.write("main", table, given[table])
        out.finish()
        folders.append(out.folder)
    return compare_runs(spark, *folders)


__all__ = ["QUERIES", "plain"]
