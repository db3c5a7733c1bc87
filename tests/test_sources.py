import re
from pathlib import Path

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from dealtide.model import RAW_COLUMNS
from dealtide.session import shared_folder, store
from dealtide.sources.exports import read_raw
from dealtide.operators import digests, expectations
from dealtide.plans import reports
from dealtide.sources import buckets
from dealtide.operators.findings import with_fields
from dealtide.sources.snapshot import (
    MONTH, SnapshotWriter, append_journal, compare_runs, read_journal, read_manifest, read_snapshot,
)

HEADER = "product_id,sku,name,category,cost_price,is_active\n"


def write(tmp_path, text, name="products.csv"):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_fields_are_text_as_written(spark, tmp_path):
    path = write(tmp_path, HEADER + '007,,"",\'x\', 1.50 ,"a ""b"", c\nd"\n')
    assert rows(read_raw(spark, path, "products", multiline=True)) == [
        ("007", None, "", "'x'", " 1.50 ", 'a "b", c\nd')]


def test_another_header_fails(spark, tmp_path):
    path = write(tmp_path, HEADER.replace("sku,name", "name,sku") + "1,2,3,4,5,6\n")
    with pytest.raises(Exception, match="CSV header"):
        read_raw(spark, path, "products").collect()


def test_rows_with_missing_fields_fail_unless_allowed(spark, tmp_path):
    path = write(tmp_path, HEADER + "1,2,3\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_raw(spark, path, "products").collect()
    assert rows(read_raw(spark, path, "products", strict=False)) == [
        ("1", "2", "3", None, None, None)]


def test_a_line_break_in_a_field_is_never_misread(spark, tmp_path):
    for row in ('1,"a\nb",c,d,e,f\n', '1,a,b,c,d,"e\nf"\n'):
        path = write(tmp_path, HEADER + row)
        assert len(rows(read_raw(spark, path, "products", multiline=True))) == 1
        with pytest.raises(Exception, match="(?i)malformed"):
            read_raw(spark, path, "products").collect()


def test_a_folder_of_files_is_one_table(spark, tmp_path):
    folder = tmp_path / "products.csv"
    folder.mkdir()
    write(folder, HEADER + "1,,,,,\n", "a.csv")
    write(folder, HEADER + "2,,,,,\n", "b.csv")
    got = read_raw(spark, str(folder), "products", multiline=False)
    assert [r[0] for r in rows(got)] == ["1", "2"]


def test_raw_fixture_is_all_text(raw):
    for table, columns in RAW_COLUMNS.items():
        assert raw[table].dtypes == [(c, "string") for c in columns]


def test_snapshot(spark, run_folder, raw):
    manifest = {(r.layer, r.table_name): r.row_count
                for r in read_manifest(spark, run_folder).collect()}
    assert len(manifest) == 13 + 15 and manifest[("raw", "deals")] == 13
    again = read_snapshot(spark, run_folder, "raw", verify=True)
    assert rows(again["deals"]) == rows(raw["deals"])


def test_an_unfinished_snapshot_cannot_be_read(spark, tmp_path):
    out = SnapshotWriter(spark, str(tmp_path), "half")
    out.write("main", "t", spark.range(3))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_snapshot(spark, out.folder)
    out.finish()
    assert read_snapshot(spark, out.folder, verify=True)["t"].count() == 3


def test_a_changed_snapshot_is_noticed(spark, tmp_path):
    out = SnapshotWriter(spark, str(tmp_path), "run")
    out.write("main", "t", spark.range(3))
    out.finish()
    spark.range(1).write.mode("append").parquet(f"{out.folder}/main/t")
    with pytest.raises(ValueError, match="has 4 rows, not 3"):
        read_snapshot(spark, out.folder, verify=True)


def test_intermediate_tables_go_to_the_shared_folder(spark):
    stored, measured = store(spark.range(5))
    assert measured == {"rows": 5} and stored.count() == 5
    assert stored.inputFiles()[0].startswith(f"file://{shared_folder(spark)}")


def test_a_run_id_is_used_once(spark, tmp_path):
    out = SnapshotWriter(spark, str(tmp_path), "run")
    out.write("main", "numbers", spark.range(5))
    out.finish()
    with pytest.raises(ValueError, match="exists"):
        SnapshotWriter(spark, str(tmp_path), "run")
    assert [r.row_count for r in read_manifest(spark, out.folder).collect()] == [5]


def test_a_refresh_leaves_no_intermediate_tables(spark, raw, tmp_path):
    from dealtide.plans.refresh import refresh

    tables = Path(shared_folder(spark)) / "dealtide-tables"
    before = {p.name for p in tables.glob("*")}
    run = refresh(spark, raw, str(tmp_path), run_id="one")
    assert {p.name for p in tables.glob("*")} == before
    assert read_snapshot(spark, run, verify=True)["deals"].count() > 0
    with pytest.raises(ValueError, match="exists"):
        refresh(spark, raw, str(tmp_path), run_id="one")


# ---- fingerprints -------------------------------------------------------------------------


def snapshot_of(spark, folder, run_id, **tables):
    out = SnapshotWriter(spark, str(folder), run_id)
    for name, df in tables.items():
        out.write("main", name, df)
    out.finish()
    return out.folder


def test_fingerprints_do_not_depend_on_order_or_partitions(spark, tables):
    for name in ("deals", "payments", "rejects"):
        groups = digests.groups_of(tables[name].columns)
        one = digests.fingerprint(tables[name].coalesce(1), groups)
        assert one == digests.fingerprint(tables[name].repartition(5).sortWithinPartitions(tables[name].columns[-1]), groups)


@pytest.mark.parametrize("changed", [
    [("a", "x"), ("b", "y"), ("b", "y"), ("c", None)],  # a copy of another row
    [("a", "x"), ("a", "x"), ("b", "y"), (None, "c")],  # a value in the other column
    [("a", "x"), ("a", "x"), ("b", "y"), ("c", "")],  # empty in place of NULL
    [("a", "x"), ("a", "y"), ("b", "x"), ("c", None)],  # values swapped between rows
    [("x", "a"), ("a", "x"), ("b", "y"), ("c", None)],  # and within a row
])
def test_fingerprints_see_every_change(spark, changed):
    groups = digests.groups_of(["k", "v"])
    given = [("a", "x"), ("a", "x"), ("b", "y"), ("c", None)]
    one, other = (digests.fingerprint(spark.createDataFrame(r, "k string, v string"), groups) for r in (given, changed))
    assert one[0] == other[0] and one[1] != other[1]


def test_fingerprints_are_sums_modulo_64_bits(spark):
    """Three partial sums give the sum of whole hashes, however many rows there are."""
    df = spark.range(1000).select(F.col("id").cast("string").alias("v"))
    seeds = [
        sum(r[0] % (1 << 64) for r in df.select(digests._hash(["v"], seed)).collect()) % (1 << 64)
        for seed in ("first", "second")
    ]
    assert digests.fingerprint(df, {"row": ["v"]}) == (1000, {"row": "".join(f"{s:016x}" for s in seeds)})
    assert digests.fingerprint(df.limit(0), {"row": ["v"]}) == (0, {"row": "0" * 32})


@pytest.mark.parametrize("column, value, message", [
    ("name", "'another'", "users has other values"), ("user_id", "concat(user_id, 'x')", "users has other keys"),
])
def test_verifying_a_snapshot_finds_one_changed_value(spark, tables, tmp_path, column, value, message):
    folder = snapshot_of(spark, tmp_path, "run", users=tables["users"])
    assert read_snapshot(spark, folder, verify=True)["users"].count() > 1
    first = F.col("user_id") == tables["users"].agg(F.min("user_id")).first()[0]
    changed = tables["users"].withColumn(column, F.when(first, F.expr(value)).otherwise(F.col(column)))
    changed.write.mode("overwrite").parquet(f"{folder}/main/users")
    with pytest.raises(ValueError, match=message):
        read_snapshot(spark, folder, verify=True)


def test_runs_are_compared_by_their_manifests(spark, tables, tmp_path):
    one = snapshot_of(spark, tmp_path, "one", users=tables["users"], deals=tables["deals"])
    other = snapshot_of(spark, tmp_path, "two", users=tables["users"].limit(1), payments=tables["payments"])
    n, p = tables["users"].count(), tables["payments"].count()
    found = compare_runs(spark, one, other)
    assert rows(found, "table_name", "rows_before", "rows_after", "same_keys", "same_values") == rows(spark.createDataFrame(
        [("deals", tables["deals"].count(), None, None, False), ("payments", None, p, None, False), ("users", n, 1, False, False)],
        "table_name string, b long, a long, k boolean, v boolean"))


# ---- tables by month ----------------------------------------------------------------------


def test_a_period_reads_only_its_months(spark, tmp_path):
    days = ["2024-01-31 23:59:59", "2024-02-01 00:00:00", "2024-02-29 12:00:00", "2024-03-01 00:00:00", "2025-02-01 00:00:00", None]
    deals = spark.createDataFrame([(str(n), d) for n, d in enumerate(days)], "deal_id string, d string").select(
        "deal_id", F.col("d").cast("timestamp").alias("created_at"))
    stored = read_snapshot(spark, snapshot_of(spark, tmp_path, "run", deals=deals), verify=True)
    assert stored["deals"].columns == ["deal_id", "created_at"] and rows(stored["deals"]) == rows(deals)
    assert (tmp_path / "run/main/deals" / f"{MONTH}=__HIVE_DEFAULT_PARTITION__").exists()
    for start, end, expected, months in (
        ("2024-02-01", "2024-03-01", "12", {"2024-02"}), ("2024-02-01", "2024-03-02", "123", {"2024-02", "2024-03"}),
        (None, "2024-02-01", "0", {"2024-01"}), ("2024-03-01", None, "34", {"2024-03", "2025-02"}),
        ("2023-01-01", "2023-06-01", "", set()),
    ):
        part = stored.between("deals", "created_at", start, end)
        assert sorted(r["deal_id"] for r in part.collect()) == list(expected)
        plan = plan_of(part)
        assert f"PartitionFilters: [isnotnull({MONTH}" in plan
        scanned = spark.read.parquet(f"{tmp_path}/run/main/deals")
        if start:
            scanned = scanned.filter(F.col(MONTH) >= start[:7])
        if end:
            scanned = scanned.filter(F.col(MONTH) < end[:7] if end.endswith("-01") else F.col(MONTH) <= end[:7])
        assert {r[MONTH] for r in scanned.select(MONTH).distinct().collect()} == months
    unbounded = stored.between("deals", "created_at", None, None)
    assert rows(unbounded) == rows(deals)


def test_period_reports_filter_partitions(tables):
    for report in (
        reports.funnel(tables, "2025-03-03", "2025-03-05"), reports.managers(tables, "2025-03-01", None, won=True),
        reports.lead_sources(tables, None, "2025-04-01", with_romi=True),
    ):
        scans = [x for x in plan_of(report).splitlines() if "main/deals" in x or "main/marketing_costs" in x]
        assert scans and all(f"PartitionFilters: [isnotnull({MONTH}" in x for x in scans if "created_at" in x or "cost_date" in x)
        assert any(MONTH in x for x in scans)


# ---- the journal of all runs --------------------------------------------------------------


def test_a_run_replaces_its_own_journal_entries_only(spark, tables, tmp_path):
    folder = str(tmp_path / "journal")
    assert read_journal(spark, folder).count() == 0
    log = tables["rejects"]
    one, two = log.withColumn("run_id", F.lit("one")), log.limit(3).withColumn("run_id", F.lit("two"))
    for entries, run_id in ((one, "one"), (two, "two"), (one.limit(2), "one"), (one, "one")):
        append_journal(entries, folder, run_id)
    assert rows(read_journal(spark, folder)) == rows(one.unionByName(two))
    plan = plan_of(reports.defect_summary({"rejects": read_journal(spark, folder)}, run_id="two"))
    assert "PartitionFilters: [isnotnull(run_id" in plan
    summed = reports.defect_detail({"rejects": read_journal(spark, folder)}, run_id="two")
    assert summed.count() == 3
    append_journal(one.limit(0), folder, "one")
    assert rows(read_journal(spark, folder)) == rows(two)


def test_fields_of_source_rows_are_read_from_their_variant(spark, tables, tmp_path):
    folder = str(tmp_path / "journal")
    fields = {"of_deal": "deal_id", "odd": "it's [0].a"}
    assert read_journal(spark, folder, fields).columns == [*tables["rejects"].columns, *fields]
    awkward = ['{"deal_id": null}', '{"deal_id": 7}', '{"it\'s [0].a": "x"}', "no JSON", "", None, "[]"]
    some = tables["rejects"].limit(1).drop("raw_data").crossJoin(
        spark.createDataFrame([(r,) for r in awkward], "raw_data string")
    )
    log = tables["rejects"].unionByName(some)
    append_journal(log, folder, "run-1")
    stored = read_journal(spark, folder, fields)
    parsed = F.get_json_object("raw_data", "$.deal_id")
    expected = log.withColumns({"of_deal": parsed, "odd": F.when(F.col("raw_data") == awkward[2], "x")})
    assert rows(stored) == rows(expected) == rows(with_fields(log, fields))
    assert stored.filter("of_deal IS NOT NULL").count() > 1
    plan = plan_of(stored.select("of_deal"))
    with pytest.raises(ValueError):
        with_fields(log, {"a": 'a"b'})
    assert "raw_data" not in plan.split("FileScan")[1], "the text of the rows is not read"


def test_a_refresh_adds_to_the_journal_of_all_runs(spark, run_folder, tables):
    log = read_journal(spark, f"{Path(run_folder).parent}/_journal")
    assert rows(log.filter("run_id = 'run-1'")) == rows(tables["rejects"])


# ---- tables in buckets --------------------------------------------------------------------

CHILDREN = ("deal_products", "payments", "activities", "stage_history", "production_orders", "shipments")


@pytest.fixture(scope="module")
def in_buckets(spark, tables, tmp_path_factory):
    out = SnapshotWriter(spark, str(tmp_path_factory.mktemp("buckets")), "run", buckets=4)
    for name, df in tables.items():
        out.write("main", name, df)
    out.finish()
    return read_snapshot(spark, out.folder, verify=True)


def shuffled_by_deal(df) -> bool:
    return re.search(r"Exchange hashpartitioning\([^)]*(deal_id|_value|value)#", plan_of(df)) is not None


def without_broadcast(spark, question):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return question()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_buckets_change_no_table_and_stay_out_of_the_catalog(spark, tables, in_buckets):
    for name in tables:
        assert in_buckets[name].columns == tables[name].columns
        assert rows(in_buckets[name]) == rows(tables[name])
        assert (name in CHILDREN or name == "deals") == in_buckets.together(name, "deal_id", "deals", "deal_id")
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("dealtide_")]


def test_deals_and_their_children_meet_without_a_shuffle(spark, tables, in_buckets):
    names = (*CHILDREN, "deals", "pipeline_stages", "products")
    unbucketed = {n: spark.createDataFrame(tables[n].collect(), tables[n].schema) for n in names}
    for report in (
        reports.receivables, reports.deal_economics, lambda t: reports.stale_deals(t, "2025-04-01"),
    ):
        local, moved = (
            without_broadcast(spark, lambda t=t: (shuffled_by_deal(report(t)), rows(report(t))))
            for t in ({**t, **{n: F.broadcast(t[n]) for n in ("products", "pipeline_stages")}} for t in (in_buckets, unbucketed))
        )
        assert not local[0] and moved[0]
        assert local[1] == moved[1] and local[1]


def test_months_are_still_pruned_in_buckets(in_buckets):
    part = in_buckets.between("deals", "created_at", "2025-03-03", "2025-03-05")
    assert f"PartitionFilters: [isnotnull({MONTH}" in plan_of(part)
    whole = in_buckets["deals"].filter("created_at >= '2025-03-03' AND created_at < '2025-03-05'")
    assert rows(part) == rows(whole) and rows(part)


def test_children_are_checked_within_their_bucket(spark, tables, in_buckets):
    found = expectations.check(in_buckets, [*CHILDREN, "deals"])
    assert rows(found) == rows(expectations.check(dict(tables), [*CHILDREN, "deals"]))
    [check] = expectations._checks_in_buckets(in_buckets, [(child, "deal_id", "deals") for child in CHILDREN])
    assert check.count() == len(CHILDREN)
    assert not without_broadcast(spark, lambda: shuffled_by_deal(check.select("*")))
    assert plan_of(check).count("main/deals]") == 1


def test_lost_children_are_counted_within_their_bucket(spark, tmp_path):
    out = SnapshotWriter(spark, str(tmp_path), "run", buckets=4)
    deals = spark.createDataFrame([(str(n),) for n in range(50)] + [(None,)], "deal_id string")
    payments = spark.createDataFrame([(str(n), str(n)) for n in range(70)] + [("x", None)] * 3, "payment_id string, deal_id string")
    stored = [out.write("main", n, df) for n, df in (("deals", deals), ("payments", payments))]
    [check] = expectations._checks_in_buckets(out.tables, [("payments", "deal_id", "deals")])
    assert rows(check) == [("payments", "REFERENCE", "deal_id", 20)]
    assert [df.count() for df in stored] == [51, 73]


def test_uneven_buckets_are_read_as_plain_files(spark, tmp_path, monkeypatch):
    """A hot deal: its bucket would be one task of every reader."""
    monkeypatch.setattr(buckets, "SMALL_BUCKET", 10)
    hot = spark.range(9000).select(F.col("id").cast("string").alias("payment_id"), F.lit("hot").alias("deal_id"))
    cold = spark.range(100).select(F.concat(F.lit("c"), "id").alias("payment_id"), F.col("id").cast("string").alias("deal_id"))
    out = SnapshotWriter(spark, str(tmp_path / "it's here"), "run", buckets=16)
    out.write("main", "payments", hot.unionByName(cold))
    out.write("main", "shipments", cold)
    out.write("main", "activities", cold.limit(0))
    out.finish()
    kept = {r.table_name: r.buckets for r in read_manifest(spark, out.folder).collect()}
    assert kept == {"payments": None, "shipments": 16, "activities": 16}
    stored = read_snapshot(spark, out.folder, verify=True)
    assert not stored.together("payments", "deal_id", "shipments", "deal_id")
    assert {n: df.count() for n, df in stored.items()} == {"payments": 9100, "shipments": 100, "activities": 0}


def test_the_number_of_buckets_follows_the_size(spark, tmp_path, monkeypatch):
    out = SnapshotWriter(spark, str(tmp_path), "run")
    for size, expected in ((0, 1), (1, 1), (64 << 20, 1), ((64 << 20) + 1, 2), (200 << 20, 4), (1 << 40, 16384)):
        monkeypatch.setattr(out, "largest_bytes", lambda size=size: size)
        assert out.use_buckets() == expected
