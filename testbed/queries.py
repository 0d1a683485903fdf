"""One query per operator and load over the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.functions.dates import strict_date
from starload.functions.text import nonblank
from starload.operators import checks, clean, dims, fuzzy, lookup
from starload.operators.merge import first_wins, last_wins, total_order
from starload.plans import (
    inventory, issues, payload, payments, requests, schedule, worker_payments,
)
from starload.plans.run import run
from starload.session import configure, materialize, session_area
from starload.sources.payload import records
from starload.sources.scan import project, scan
from starload.sources.tables import SessionTables
from starload.sources.warehouse import Warehouse
from testbed.sources import ISSUE_SPLIT, SPLIT, source

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    """Register a query; amounts are shown as doubles, dates and times as text."""

    def shown(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = run(configure(spark), sf_dir)
        columns = []
        for name, dtype in df.dtypes:
            column = F.col(name)
            if dtype.startswith("decimal"):
                column = column.cast("double")
            elif dtype == "date":
                column = column.cast("string")
            elif dtype.startswith("timestamp"):
                column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
            columns.append(column.alias(name))
        return df.select(*columns)

    QUERIES[run.__name__] = shown
    return shown


def _split(df: DataFrame, column: str, at: str = SPLIT) -> tuple[DataFrame, DataFrame]:
    early = F.coalesce(F.expr(f"{column} < {at}"), F.lit(False))
    return df.filter(early), df.filter(~early)


def stored(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A source as a load finds it: one table, whose columns every pass reads without the joins."""
    return materialize(source(spark, d, name), f"source-{name}")


# Loads over the test tables; each leaves the tables after a first and a second run.


def inventory_tables(spark: SparkSession, d: str) -> SessionTables:
    tables = SessionTables(spark)
    for part in _split(stored(spark, d, "inventory"), "updated_date"):
        inventory.load(part, tables)
    return tables


def known_members(spark: SparkSession, d: str) -> SessionTables:
    """Dimensions another load filled before the requests come."""
    tables = SessionTables(spark)
    for name in ("d_item", "d_project", "d_property"):
        rows = source(spark, d, {"d_item": "known_items", "d_project": "known_projects",
                                 "d_property": "known_properties"}[name])
        if name == "d_item":
            values = {(name, "item_name"): F.col("item_name")}
            dims.insert_members(dims.offers(rows, values), values, tables)
        else:
            tables.append(name, dims.first_seen(rows, name, tables.read(name)))
    return tables


def request_dimensions(spark: SparkSession, d: str, tables: SessionTables) -> SessionTables:
    requests.load_dimensions(
        source(spark, d, "employees"), source(spark, d, "inventory_requests"), tables
    )
    return tables


def resolved_requests(spark: SparkSession, d: str) -> DataFrame:
    checked = requests.check(source(spark, d, "inventory_requests"))
    return requests.resolve(checked, request_dimensions(spark, d, known_members(spark, d)))


def schedule_extract(spark: SparkSession, d: str, properties: str = "properties",
                     projects: str = "projects") -> DataFrame:
    return schedule.extract(
        *[source(spark, d, n) for n in ("property_schedule", "schedule", properties, projects)]
    )


def schedule_tables(spark: SparkSession, d: str) -> SessionTables:
    tables = SessionTables(spark)
    early, _ = _split(source(spark, d, "schedule"), "startdate")
    live = source(spark, d, "property_schedule")
    schedule.load(live, early, source(spark, d, "old_properties"),
                  source(spark, d, "old_projects"), tables)
    schedule.load(live, source(spark, d, "schedule"), source(spark, d, "properties"),
                  source(spark, d, "projects"), tables)
    return tables


def issue_tables(spark: SparkSession, d: str) -> SessionTables:
    tables = SessionTables(spark)
    early, _ = _split(source(spark, d, "issue_master"), "updated_at", ISSUE_SPLIT)
    properties = source(spark, d, "properties")
    issues.load(early, source(spark, d, "projects"), properties, tables)
    issues.load(source(spark, d, "issue_master"), source(spark, d, "issue_projects"), properties,
                tables)
    return tables


def payment_tables(spark: SparkSession, d: str) -> SessionTables:
    tables = SessionTables(spark)
    every = stored(spark, d, "invoice_master")
    early, _ = _split(every, "created_date")
    for part in (early, every):
        payments.load(part, source(spark, d, "vendor"), tables)
    return tables


def worker_tables(spark: SparkSession, d: str) -> SessionTables:
    tables = SessionTables(spark, {"core_dim_date": source(spark, d, "core_dim_date")})
    every = source(spark, d, "worker_payments")
    early, _ = _split(every, "created_at")
    for part in (early, every):
        worker_payments.load(part, tables)
    return tables


def payloads(spark: SparkSession, d: str) -> DataFrame:
    """The record source as documents, two records to a document."""
    rows = source(spark, d, "payload_records")
    common = ["request_id", "item_name", "location", "requested_date"]
    record = F.coalesce(
        F.when(F.col("number_quantity").isNotNull(),
               F.to_json(F.struct(*common, F.col("number_quantity").alias("quantity")))),
        F.to_json(F.struct(*common, F.col("text_quantity").alias("quantity"))),
    )
    grouped = rows.groupBy("arrived_at", "payload_id").agg(
        F.array_sort(F.collect_list(F.struct("position", record.alias("json")))).alias("list")
    )
    body = F.concat(F.lit("["), F.concat_ws(",", F.col("list.json")), F.lit("]"))
    return grouped.select(
        F.struct(F.col("arrived_at").alias("at"), F.col("payload_id").alias("path"))
        .alias("arrival"),
        F.parse_json(body).alias("records"),
    )


def payload_tables(spark: SparkSession, d: str) -> SessionTables:
    tables = SessionTables(spark)
    # The documents are made once for both loads, as files that come in are.
    for part in _split(materialize(payloads(spark, d), "source-payloads"), "arrival.at"):
        payload.load(part, tables)
    return tables


# Sources


@query
def scan_inventory(spark, d):
    return source(spark, d, "inventory").select(*inventory.SOURCE)


@query
def project_requests(spark, d):
    rows = project(source(spark, d, "inventory_requests"), requests.REQUEST)
    return rows.select("request_id", "property_name", "project_name", "item_name", "item_type",
                       "quantity", "status")


@query
def payload_explode(spark, d):
    return records(payloads(spark, d)).select(
        F.col("arrival.path").alias("payload_id"), "position",
        *[
            F.try_variant_get("record", f"$.{f}", "string").alias(f)
            for f in ("request_id", "item_name", "location", "requested_date")
        ],
        F.try_variant_get("record", "$.quantity", "double").alias("quantity"),
    )


@query
def issues_left_join(spark, d):
    return issues.extract(*[source(spark, d, n)
                            for n in ("issue_master", "projects", "properties")])


@query
def schedule_four_way(spark, d):
    return schedule_extract(spark, d)


# Filters and checks


@query
def filter_not_null(spark, d):
    return payments.readable(source(spark, d, "invoice_master")).select(
        "avenue_created_invoice_id", "supplier_name", "created_date", "total_bill_amount"
    )


@query
def filter_nonblank(spark, d):
    rows = source(spark, d, "inventory_requests")
    return rows.filter(nonblank(F.col("item_type")) & nonblank(F.col("status"))).select(
        "request_id", "item_type", "status"
    )


@query
def filter_soft_delete(spark, d):
    return clean.live(source(spark, d, "property_schedule"), "is_deleted").select(
        "propertyscheduleid", "propertyid"
    )


@query
def complete_requests(spark, d):
    return requests.check(source(spark, d, "inventory_requests")).select(
        "request_id", "item_type", "status", "raised_date_key", "updated_date_key", clean.REASON
    )


@query
def complete_payload(spark, d):
    return payload.check(payloads(spark, d)).select(
        F.col("arrival.path").alias("payload_id"), "position", clean.REASON
    )


@query
def parse_payload_date(spark, d):
    rows = source(spark, d, "payload_records")
    return rows.select("payload_id", "position", "requested_date",
                       strict_date(F.col("requested_date")).alias("parsed"))


@query
def schedule_null_dates(spark, d):
    return schedule.check(schedule_extract(spark, d)).select(
        "scheduleid", "startdate", "enddate", "start_date_key", "end_date_key", clean.REASON
    )


# Distinct values and batch reduction


@query
def distinct_item_types(spark, d):
    rows = source(spark, d, "inventory_requests")
    return rows.select("item_type").filter(nonblank(F.col("item_type"))).distinct()


@query
def distinct_employees(spark, d):
    return requests.employees(source(spark, d, "employees"))


@query
def last_wins_batch(spark, d):
    rows = clean.required(source(spark, d, "inventory"), "updated_date")
    return last_wins(rows, ["inventory_id"], total_order(rows, ["updated_date"], ["inventory_id"]))


@query
def first_wins_batch(spark, d):
    rows = project(source(spark, d, "inventory_requests"), requests.REQUEST)
    return first_wins(rows, ["request_id"], total_order(rows, ["updated_at"], ["request_id"]))


# Dimensions and keys


@query
def dim_date(spark, d):
    tables = SessionTables(spark)
    values = {("d_date", "date"): [F.col("startdate"), F.col("enddate")]}
    dims.insert_members(dims.offers(schedule_extract(spark, d), values), values, tables)
    return tables.read("d_date")




@query
def dim_item_type(spark, d):
    return request_dimensions(spark, d, SessionTables(spark)).read("d_item_type")


@query
def dim_request_status(spark, d):
    return request_dimensions(spark, d, SessionTables(spark)).read("d_request_status")


@query
def dim_employees(spark, d):
    rows = requests.employees(source(spark, d, "employees"))
    return dims.first_seen(rows, "d_employees", SessionTables(spark).read("d_employees"))


@query
def dim_vendor_first_seen(spark, d):
    return payment_tables(spark, d).read("d_vendor")


@query
def dim_invoice(spark, d):
    return payment_tables(spark, d).read("d_invoice")


@query
def dim_issue_attrs(spark, d):
    tables = issue_tables(spark, d)
    parts = [
        tables.read(dim).select(F.lit(dim).alias("dimension"), F.col(natural).alias("member"),
                                F.col(key).alias("member_key"))
        for dim, natural, key, _ in issues.ATTRIBUTES.values()
    ]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every


@query
def dim_project_scd1(spark, d):
    return issue_tables(spark, d).read("d_project")


@query
def dim_property_scd1(spark, d):
    return schedule_tables(spark, d).read("d_property")


@query
def dim_worker_scd1(spark, d):
    return worker_tables(spark, d).read("core_dim_worker")


@query
def key_assignment(spark, d):
    tables = SessionTables(spark)
    rows = source(spark, d, "worker_payments")
    values = {("dim_reporter", "reported_by_email"): F.col("worker_name")}
    dims.insert_members(dims.offers(rows, values), values, tables)
    return tables.read("dim_reporter")


@query
def key_stability(spark, d):
    """Keys of the properties after the first load and after the second."""
    tables = SessionTables(spark)
    early, _ = _split(source(spark, d, "schedule"), "startdate")
    live = source(spark, d, "property_schedule")
    schedule.load_dimensions(
        schedule.check(schedule.extract(live, early, source(spark, d, "old_properties"),
                                        source(spark, d, "old_projects"))), tables)
    before = tables.read("d_property")
    schedule.load_dimensions(schedule.check(schedule_extract(spark, d)), tables)
    after = tables.read("d_property")
    return after.join(
        before.select("property_id", F.col("property_key").alias("first_key")), "property_id", "left"
    ).select("property_id", "first_key", F.col("property_key").alias("second_key"),
             "property_name")


@query
def purge_blank_members(spark, d):
    tables = SessionTables(spark)
    inventory.load(source(spark, d, "blank_inventory"), tables)
    before = tables.read("d_item")
    blanks = dims.blank_members(before, "d_item", "item_name",
                                requests.referring_facts(tables, "d_item"))
    after = dims.purge(before, "d_item", blanks)
    marks = blanks.select("item_key", "referenced")
    left = after.select("item_key", F.lit(True).alias("left"))
    return before.join(marks, "item_key", "left").join(left, "item_key", "left").select(
        "item_key", "item_name",
        F.when(F.col("left").isNull(), "purged").when(F.col("referenced"), "held")
        .otherwise("kept").alias("outcome"),
    )


# Joins


@query
def fuzzy_vendor_match(spark, d):
    rows = payments.extract(source(spark, d, "invoice_master"), source(spark, d, "vendor"))
    return rows.select("invoice_id", "vendor_id", "vendor_name", "created_date",
                       "total_bill_amount")


@query
def fuzzy_casefold(spark, d):
    parts = scan(spark, f"{d}/part.parquet", ["p_name", "p_type"])
    return fuzzy.name_pairs(fuzzy.distinct_names(parts, "p_name"),
                            fuzzy.distinct_names(parts, "p_type"))


@query
def fuzzy_blocked(spark, d):
    """Whole customer names, with and without wildcards, in longer names."""
    longer = fuzzy.distinct_names(source(spark, d, "customer_names"), "name")
    return fuzzy.blocked_pairs(longer, fuzzy.distinct_names(source(spark, d, "name_patterns"), "name"))


@query
def match_many_vendors(spark, d):
    """Invoices matched to more vendors than are compared one by one."""
    return payments.extract(source(spark, d, "customer_invoices"), source(spark, d, "customer_vendors")).select(
        "invoice_id", "vendor_id", "vendor_name", "amount_to_pay")


@query
def resolve_requests(spark, d):
    return clean.kept(resolved_requests(spark, d)).select(
        "request_id", "request_status_key", "item_type_key", "project_key", "property_key",
        "item_key", "quantity", "raised_date_key", "updated_date_key",
    )


@query
def rejected_requests(spark, d):
    return clean.rejects(resolved_requests(spark, d), "requests", "request_id")


@query
def resolve_issues(spark, d):
    tables = issue_tables(spark, d)
    rows = clean.kept(issues.check(source(spark, d, "issue_master")))
    return lookup.or_null(rows, [
        lookup.Lookup(column, tables.read(dim), natural, key, output)
        for column, (dim, natural, key, output) in issues.ATTRIBUTES.items()
    ]).select("issue_id", "updated_at", *[a[3] for a in issues.ATTRIBUTES.values()])


@query
def resolve_worker_dates(spark, d):
    tables = SessionTables(spark, {"core_dim_date": source(spark, d, "core_dim_date")})
    rows = worker_payments.check(source(spark, d, "worker_payments"))
    return lookup.or_fail(rows, worker_payments.created_date(tables)).select(
        "payment_id", "created_date", "created_date_key"
    )


@query
def strict_date_misses(spark, d):
    tables = SessionTables(spark, {"core_dim_date": source(spark, d, "shipping_dates")})
    rows = worker_payments.check(source(spark, d, "worker_payments"))
    return lookup.misses(rows, worker_payments.created_date(tables))


# Facts


@query
def upsert_inventory(spark, d):
    return inventory_tables(spark, d).read("f_inventory")


@query
def insert_new_requests(spark, d):
    every = stored(spark, d, "inventory_requests")
    early, _ = _split(every, "updated_at")
    tables = known_members(spark, d)
    for part in (early, every):
        requests.load(source(spark, d, "employees"), part, tables)
    return tables.read("fact_inventory_requests").drop("request_key")


@query
def insert_absent_payments(spark, d):
    return payment_tables(spark, d).read("f_payments").drop("payment_key")


@query
def upsert_schedule(spark, d):
    return schedule_tables(spark, d).read("f_property_schedule")


@query
def upsert_issues(spark, d):
    return issue_tables(spark, d).read("fact_issues")


@query
def upsert_worker_payments(spark, d):
    return worker_tables(spark, d).read("fact_worker_payments")


@query
def upsert_payload(spark, d):
    return payload_tables(spark, d).read("f_inventory_requests")


# Counts and checks


@query
def load_counters(spark, d):
    return clean.counters(resolved_requests(spark, d))


@query
def empty_target_bootstrap(spark, d):
    """Rows of each target of the stock load, before and after its first run."""
    names = ("d_date", "d_item", "d_project", "f_inventory")
    tables = SessionTables(spark)

    def counts(column):
        every = None
        for name in names:
            one = tables.read(name).agg(F.count(F.lit(1)).alias(column)).select(
                F.lit(name).alias("table_name"), column
            )
            every = one if every is None else every.unionByName(one)
        return every

    before = counts("rows_before")
    inventory.load(source(spark, d, "inventory"), tables)
    return before.join(counts("rows_after"), "table_name")


@query
def check_unique(spark, d):
    """Inventory ids that come more than once, so that a batch must be reduced first."""
    return checks.repeated_keys(source(spark, d, "inventory"), ["inventory_id"])


@query
def check_foreign_keys(spark, d):
    """Shipping days of stock rows that are no order day, by date key."""
    tables = SessionTables(spark, {"core_dim_date": source(spark, d, "core_dim_date")})
    fact = inventory_tables(spark, d).read("f_inventory")
    return checks.orphans(fact, "date_key", tables.read("core_dim_date"), "date_key")


@query
def check_dimensions(spark, d):
    """What keeps these members from being published."""
    members = source(spark, d, "members")
    keys = checks.repeated_keys(members, ["vendor_key"]).agg(F.count(F.lit(1)).alias("n_rows"))
    return keys.select(F.lit("repeated vendor_key").alias("problem"), "n_rows").unionByName(
        checks.too_long(members, "d_vendor").select(
            F.concat("column", F.lit(" too long")).alias("problem"), "n_rows"))


@query
def fine_amounts(spark, d):
    """Quantities kept to their last digit, or rejected."""
    checked = inventory.check(source(spark, d, "fine_inventory"))
    kept = F.when(F.col(clean.REASON).isNull(), F.col("quantity").try_cast("decimal(38,18)"))
    return checked.select(
        "inventory_id", F.coalesce(clean.REASON, F.lit("loaded")).alias("outcome"),
        (kept * 10_000_000).alias("ten_millionths"))


# The published path: two loads into tables on disk, and the fact read back.


def published(spark: SparkSession, load, *batches) -> Warehouse:
    warehouse = Warehouse(spark, f"{session_area(spark)}/published-{uuid.uuid4().hex}")
    for batch in batches:
        run(load, warehouse, *batch)
    return warehouse


def published_request_tables(spark: SparkSession, d: str) -> Warehouse:
    every = stored(spark, d, "inventory_requests")
    early, _ = _split(every, "updated_at")
    staff = source(spark, d, "employees")
    warehouse = Warehouse(spark, f"{session_area(spark)}/published-{uuid.uuid4().hex}")
    known = known_members(spark, d)
    for name in ("d_item", "d_project", "d_property"):
        warehouse.append(name, known.read(name))
    for part in (early, every):
        run(requests.load, warehouse, staff, part)
    return warehouse


@query
def published_inventory(spark, d):
    parts = _split(stored(spark, d, "inventory"), "updated_date")
    return published(spark, inventory.load, *[[p] for p in parts]).read("f_inventory")


@query
def published_requests(spark, d):
    return published_request_tables(spark, d).read("fact_inventory_requests").drop("request_key")


@query
def published_request_keys(spark, d):
    """Bucket keys of the stored requests: as many as rows."""
    return published_request_tables(spark, d).read("fact_inventory_requests").agg(
        F.count("request_key").alias("n_keys"), F.countDistinct("request_key").alias("n_different"))


@query
def published_payments(spark, d):
    every, vendors = stored(spark, d, "invoice_master"), source(spark, d, "vendor")
    early, _ = _split(every, "created_date")
    return published(spark, payments.load, [early, vendors], [every, vendors]).read(
        "f_payments").drop("payment_key")


@query
def last_payment_wins(spark, d):
    """Of payments with one id the last one stays."""
    tables = SessionTables(spark, {"core_dim_date": source(spark, d, "core_dim_date")})
    worker_payments.load(source(spark, d, "repeated_payments"), tables)
    return tables.read("fact_worker_payments").select(
        "payment_id", "work_duration_type", "total_hours_worked", "gross_amount", "created_date_key")


@query
def bad_requests(spark, d):
    """Requests with blank or tab members and odd quantities, and what became of them."""
    tables = known_members(spark, d)
    rows = source(spark, d, "bad_requests")
    requests.load_dimensions(source(spark, d, "employees"), rows, tables)
    return requests.resolve(requests.check(rows), tables).groupBy(
        F.coalesce(clean.REASON, F.lit("loaded")).alias("outcome"), "item_type_key").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("quantity").try_cast("double")).alias("quantity"))
