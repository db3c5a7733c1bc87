"""Full refresh: raw tables to cleaned, journalled, checked tables in a new snapshot."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from dealtide.operators import expectations
from dealtide.operators.findings import accepted, entries, journal
from dealtide.operators.unions import union_all
from dealtide.plans import cleaning
from dealtide.session import prepare, release_shuffles, size_shuffles, store, stored_until_done
from dealtide.sources.snapshot import SnapshotWriter, append_journal

Tables = Mapping[str, DataFrame]

JOBS_AT_ONCE = 4
#: Tables that others are built from.
PARENTS = ("companies", "pipeline_stages", "products", "deals")


def steps(raw: Tables, options: cleaning.Options) -> dict[str, Callable[[Tables], DataFrame]]:
    """How to annotate each table, in build order; every step gets the tables built before."""
    c = cleaning
    return {
        "users": lambda m: c.users(raw["users"], options),
        "pipeline_stages": lambda m: c.pipeline_stages(raw["pipeline_stages"], options),
        "companies": lambda m: c.companies(raw["companies"], options),
        "products": lambda m: c.products(raw["products"], raw["deal_products"], options),
        "contacts": lambda m: c.contacts(raw["contacts"], m["companies"], options),
        "deals": lambda m: c.deals(raw["deals"], m["pipeline_stages"], options),
        "deal_products": lambda m: c.deal_products(
            raw["deal_products"], m["deals"], m["products"], options
        ),
        "payments": lambda m: c.payments(raw["payments"], m["deals"], options),
        "activities": lambda m: c.activities(raw["activities"], m["deals"], options),
        "stage_history": lambda m: c.stage_history(
            raw["stage_history"], m["deals"], m["pipeline_stages"], options
        ),
        "production_orders": lambda m: c.production_orders(
            raw["production_orders"], m["deals"], options
        ),
        "shipments": lambda m: c.shipments(raw["shipments"], m["deals"], options),
        "marketing_costs": lambda m: c.marketing_costs(raw["marketing_costs"], options),
    }


class Cleaned(dict):
    """Cleaned tables by name, as plans. A table is planned when it is first asked for.

    For single tables and ad-hoc questions; :func:`refresh` builds and stores all of them.
    """

    def __init__(self, raw: Tables, options: cleaning.Options = cleaning.DEFAULTS):
        super().__init__()
        self.raw = raw
        self.options = options
        self._annotated: dict[str, DataFrame] = {}

    def annotated(self, table: str) -> DataFrame:
        if table not in self._annotated:
            self._annotated[table] = steps(self.raw, self.options)[table](_Parents(self))
        return self._annotated[table]

    def __missing__(self, table: str) -> DataFrame:
        if table == "sources":
            self[table] = cleaning.sources(self.raw["deals"], self.raw["marketing_costs"])
        else:
            self[table] = _finished(table, accepted(self.annotated(table)))
        return self[table]

    def entries(self, *tables: str, extra: bool = True) -> DataFrame:
        """Journal entries of the given tables. What they look up first is looked up side by side; tables that
        others refer to come before them."""
        for table in PARENTS:
            if table in tables:
                self.annotated(table)
        with ThreadPoolExecutor(JOBS_AT_ONCE) as jobs:
            list(jobs.map(self.annotated, tables))
        return union_all([entries(self.annotated(t), t, extra) for t in tables])


class _Parents:
    """What the steps see of the tables before them."""

    def __init__(self, cleaned: Cleaned):
        self._cleaned = cleaned

    def __getitem__(self, table: str) -> DataFrame:
        # One version of every deal stays, so their ids are known without ranking the versions;
        # not so if rows with malformed values are dropped.
        if table == "deals" and self._cleaned.options.on_cast_error == "fail":
            return self._cleaned.raw["deals"].select("deal_id")
        return self._cleaned[table]


def _finished(table: str, rows: DataFrame) -> DataFrame:
    return cleaning.with_unknown_stage(rows) if table == "pipeline_stages" else rows


#: Tables of one level do not refer to each other: they are built side by side.
LEVELS = (
    ("sources", "users", "pipeline_stages", "companies", "products"),
    ("contacts", "marketing_costs"),
    ("deals",),
    ("deal_products", "payments", "activities", "stage_history", "production_orders", "shipments"),
)
#: Folder of the journal of all runs, beside the runs.
JOURNAL = "_journal"
#: Bytes that a shuffle of a whole table takes, for each byte of the stored table.
SHUFFLED_PER_STORED = 4


def refresh(
    spark: SparkSession,
    raw: Tables,
    folder: str,
    run_id: str | None = None,
    options: cleaning.Options = cleaning.DEFAULTS,
    constraints: str = "fail",
    extra: bool = True,
    logged_at: datetime.datetime | None = None,
) -> str:
    """Build everything into a new run folder below ``folder`` and return that folder.

    Annotated rows are written to the shared folder first: the accepted rows, the journal and all
    later tables read them from there instead of repeating the joins and windows. These tables are
    deleted at the end. A ``run_id`` can be used once. With
    ``constraints='fail'`` a broken constraint leaves the run without a manifest; with
    ``'quarantine'`` the rows that break one are dropped and journalled.

    The entries of a finished run are added to the journal of all runs, ``folder``/:data:`JOURNAL`. Should
    that fail, :func:`dealtide.sources.snapshot.append_journal` adds them again.
    """
    if constraints not in ("fail", "quarantine"):
        raise ValueError("constraints must be 'fail' or 'quarantine'")
    prepare(spark)
    run_id = run_id or uuid.uuid4().hex
    out = SnapshotWriter(spark, folder, run_id)
    main = out.tables
    found: list[DataFrame] = []

    def build(table: str) -> None:
        if table == "sources":
            rows = cleaning.sources(raw["deals"], raw["marketing_costs"])
        else:
            annotated, _ = store(steps(raw, options)[table](main))
            found.append(entries(annotated, table, extra))
            rows = _finished(table, accepted(annotated))
        if constraints == "quarantine":
            checked, _ = store(expectations.quarantine(rows, table, main))
            found.append(entries(checked, table))
            rows = accepted(checked)
        out.write("main", table, rows)

    with stored_until_done(spark), ThreadPoolExecutor(JOBS_AT_ONCE) as jobs:
        raw = dict(jobs.map(lambda item: (item[0], out.write("raw", *item)), raw.items()))
        size_shuffles(spark, SHUFFLED_PER_STORED * out.largest_bytes())
        out.use_buckets()
        for level in LEVELS:
            list(jobs.map(build, level))
            if constraints == "fail":
                expectations.enforce(main, level)
            release_shuffles(spark)
        log = journal(union_all(found), run_id, logged_at)
        out.write("main", "rejects", log)
        expectations.enforce(main, ["rejects"])
        out.finish()
    append_journal(main["rejects"], f"{folder.rstrip('/')}/{JOURNAL}", run_id)
    return out.folder
