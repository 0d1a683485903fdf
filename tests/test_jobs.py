"""Edge rows of each load."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import (
    EMPLOYEES, INVENTORY, INVOICES, ISSUES, PAYMENTS, PROJECTS, PROPERTIES, PROPERTY_SCHEDULE,
    REQUESTS, SCHEDULE, VENDORS, at, day, frame, invoice, members, named_fact, rows,
    session_tables, worker_payment,
)
from starload.operators.lookup import UnknownMember
from starload.plans import (
    inventory, issues, payload, payments, requests, schedule, worker_payments,
)
from starload.schemas import conform
from starload.sources.payload import read_payloads

Q = Decimal


def reasons(report):
    return rows(report.rejects(), "key", "reason")


# Stock


def test_inventory(spark):
    tables = session_tables(spark)
    report = inventory.load(frame(
        spark, INVENTORY,
        ("1", "nail", Q(5), "north", at("2024-01-02")),
        ("1", "nail", Q(7), "south", at("2024-01-01T23:59:59")),
        ("2", None, Q(1), "north", at("2024-01-05")),
        ("3", "bolt", Q(1), None, at("2024-01-06")),
        ("4", "bolt", Q(1), "west", None),
        (None, "gear", Q(1), "east", at("2024-01-07")),
        ("5", "", None, "north", at("2024-01-01")),
    ), tables)
    assert reasons(report) == [
        ("2", "missing item_name"), ("3", "missing location"), ("4", "missing updated_date"),
        (None, "missing inventory_id"),
    ]
    # Members of rejected rows stay, as far as the row got.
    assert members(tables, "d_item") == [("",), ("bolt",), ("gear",), ("nail",)]
    assert members(tables, "d_project") == [
        (None, "east"), (None, "north"), (None, "south")]
    assert rows(tables.read("d_date"), "date_key") == [
        (20240101,), (20240102,), (20240105,), (20240106,), (20240107,)]
    fact = named_fact(tables, "f_inventory", item_key=("d_item", "item_key", "item_name"),
                      project_key=("d_project", "project_key", "project_name"))
    assert rows(fact, "inventory_id", "item_key_name", "quantity", "project_key_name",
                "date_key") == [("1", "nail", 5.0, "north", 20240102),
                                ("5", "", None, "north", 20240101)]
    assert rows(report.counters()) == [
        ("loaded", 3), ("missing inventory_id", 1), ("missing item_name", 1),
        ("missing location", 1), ("missing updated_date", 1)]


def test_inventory_finds_project_by_lowest_key(spark):
    projects = frame(spark, "project_key long, project_id string, project_name string",
                     (4, "a", "north"), (2, "b", "north"))
    tables = session_tables(spark, d_project=projects)
    inventory.load(frame(spark, INVENTORY, ("1", "nail", Q(5), "north", at("2024-01-02"))), tables)
    assert rows(tables.read("f_inventory"), "project_key") == [(2,)]
    assert tables.read("d_project").count() == 2


# Requests

REQUEST_MEMBERS = {
    "d_item": ("item_key long, item_name string", [(1, "nail")]),
    "d_project": ("project_key long, project_id string, project_name string", [(1, "p", "north")]),
    "d_property": ("property_key long, property_id string, property_name string",
                   [(1, "h", "house")]),
}


def request_tables(spark, **more):
    frames = {n: frame(spark, s, *r) for n, (s, r) in {**REQUEST_MEMBERS, **more}.items()}
    return session_tables(spark, **frames)


def request(number, status="open", kind="tool", quantity=1, item="nail", project="north",
            house="house", updated="2024-02-01"):
    return (number, house, project, item, kind, None if quantity is None else Q(quantity), status,
            at("2024-01-31T23:59:59"), at(updated) if updated else None)


def test_requests(spark):
    tables = request_tables(spark)
    staff = frame(spark, EMPLOYEES, ("e1", "A", "B", "z@x"), ("e1", "A", "B", "a@x"),
                  ("e1", "A", "B", "z@x"), (None, "N", "N", "n@x"))
    report = requests.load(staff, frame(
        spark, REQUESTS, request("1", quantity=0), request("2", quantity=None),
        request("3", status=""), request("4", kind=None), request("5", status="  "),
        request("6", item="cog", project="mars"), request("7", item="cog"),
        request("8", updated=None), request("9", house="shed", item="cog"),
        request("1", quantity=9, updated="2024-02-02"), request("", quantity=2),
    ), tables)
    assert reasons(report) == [
        ("", "incomplete"), ("3", "incomplete"), ("4", "incomplete"), ("5", "unknown status"),
        ("6", "unknown project_name"), ("7", "unknown item_name"),
        ("9", "unknown property_name"),
    ]
    assert rows(tables.read("fact_inventory_requests"), "request_id", "quantity",
                "raised_date_key", "updated_date_key") == [
        ("1", 0.0, 20240131, 20240201), ("2", None, 20240131, 20240201),
        ("8", 1.0, 20240131, None)]
    assert members(tables, "d_employees") == [("e1", "A", "B", "a@x")]
    assert members(tables, "d_item_type") == [("tool",)]
    assert members(tables, "d_request_status") == [("open",)]

    requests.load(staff, frame(spark, REQUESTS, request("2", quantity=5), request("10")), tables)
    assert rows(tables.read("fact_inventory_requests"), "request_id", "quantity") == [
        ("1", 0.0), ("10", 1.0), ("2", None), ("8", 1.0)]
    keys = [r[0] for r in rows(tables.read("fact_inventory_requests"), "request_key")]
    assert len(set(keys)) == 4 and min(keys) > 0


def test_purge_keeps_members_in_use_and_tabs(spark):
    tables = request_tables(
        spark,
        d_item=("item_key long, item_name string",
                [(1, "nail"), (2, ""), (3, "  "), (4, "\t"), (5, None)]),
        f_inventory=("inventory_id string, item_key long, project_key long, date_key int",
                     [("x", 2, 1, 20240101)]),
        d_item_type=("item_type_key long, item_type string", [(1, " "), (2, "tool")]),
    )
    found = requests.purge_blanks(tables)
    assert rows(tables.read("d_item"), "item_key") == [(1,), (2,), (4,)]
    assert rows(tables.read("d_item_type"), "item_type_key") == [(2,)]
    assert rows(found["d_item"], "item_key", "referenced") == [(2, True), (3, False), (5, False)]


# Payments


def test_payments(spark):
    tables = session_tables(spark)
    vendors = frame(spark, VENDORS, ("v1", "ACME"), ("v2", "Acme Steel Ltd"), ("v3", "Other"),
                    (None, "acme"))
    first = frame(
        spark, INVOICES, invoice("i1", "Acme Steel", "2024-01-01T10:00:00", 10),
        invoice("i1", "Acme Steel", "2024-01-01T12:00:00", 11),
        invoice(None, "Acme Steel", "2024-01-01", 1), invoice("i2", None, "2024-01-01", 1),
        invoice("i3", "nobody", "2024-01-01", 1),
    )
    report = payments.load(first, vendors, tables)
    assert reasons(report) == [("i1", "missing vendor_id"), ("i1", "missing vendor_id")]
    fact = dict(vendor_key=("d_vendor", "vendor_key", "vendor_id"),
                invoice_key=("d_invoice", "invoice_key", "invoice_id"))
    shown = ("vendor_key_name", "invoice_key_name", "date_key", "amount_to_pay")
    want = [("v1", "i1", 20240101, 10.0), ("v2", "i1", 20240101, 10.0)]
    assert rows(named_fact(tables, "f_payments", **fact), *shown) == want

    renamed = frame(spark, VENDORS, ("v1", "Acme Steel"), ("v2", "acme steel ltd"))
    again = frame(spark, INVOICES, invoice("i1", "Acme Steel", "2024-01-01T09:00:00", 99),
                  invoice("i1", "Acme Steel", "2024-01-02", 5))
    payments.load(again, renamed, tables)
    assert rows(named_fact(tables, "f_payments", **fact), *shown) == sorted(
        [*want, ("v1", "i1", 20240102, 5.0), ("v2", "i1", 20240102, 5.0)], key=repr)
    assert members(tables, "d_vendor") == [("v1", "ACME"), ("v2", "Acme Steel Ltd")]
    keys = rows(tables.read("f_payments"), "payment_key")
    assert len(set(keys)) == 4


# Schedules


def test_schedule(spark):
    tables = session_tables(spark)
    live = frame(spark, PROPERTY_SCHEDULE, (1, "h1", False), (2, "h2", True), (3, "h3", None),
                 (4, "h4", False))
    plan = frame(
        spark, SCHEDULE, (10, 1, "dig", None, day("2024-01-05"), "open", Q(5)),
        (11, 1, None, day("2024-01-01"), None, "open", Q(5)),
        (12, 2, "dig", day("2024-01-02"), None, "open", Q(5)),
        (13, 3, "dig", day("2024-01-03"), None, "open", Q(5)),
        (14, 4, None, day("2024-01-04"), None, None, Q(5)),
        (None, 1, "late", day("2024-01-06"), None, "open", Q(5)),
    )
    homes = frame(spark, PROPERTIES, ("h1", "p1", "House 1", Q(10), Q(1)),
                  ("h4", "p2", "House 4", Q(40), None))
    sites = frame(spark, PROJECTS, ("p1", "Site 1"), ("p2", "Site 2"))
    report = schedule.load(live, plan, homes, sites, tables)
    assert reasons(report) == [
        ("11", "missing phasename"), ("14", "missing phasename"), (None, "missing scheduleid")]
    assert rows(tables.read("f_property_schedule"), "scheduleid", "start_date_key",
                "end_date_key") == [(10, None, 20240105)]
    assert members(tables, "d_property") == [
        ("h1", "House 1", 10.0, 1.0), ("h4", "House 4", 40.0, None)]
    assert members(tables, "d_phase") == [("dig",), ("late",)]
    assert members(tables, "d_status") == [("open",)]
    assert rows(tables.read("d_date"), "date_key") == [
        (20240101,), (20240104,), (20240105,), (20240106,)]

    keys = rows(tables.read("d_property"), "property_id", "property_key")
    richer = frame(spark, PROPERTIES, ("h1", "p1", "House 1", Q(99), None),
                   ("h4", "p2", "House 4", Q(40), None))
    schedule.load(live, plan, richer, sites, tables)
    assert rows(tables.read("d_property"), "property_id", "property_key") == keys
    assert members(tables, "d_property")[0] == ("h1", "House 1", 99.0, None)


# Issues


def issue(number, project="p1", house="h1", severity="high", when="2024-03-01", kind="leak"):
    return (number, project, house, "r@x", kind, severity, "P1", "open",
            at(when) if when else None)


def test_issues(spark):
    tables = session_tables(spark)
    homes = frame(spark, PROPERTIES, ("h1", "p1", "House 1", Q(10), Q(1)))
    sites = frame(spark, PROJECTS, ("p1", "Site 1"))
    report = issues.load(frame(
        spark, ISSUES, issue("1"), issue("1", severity="low", when="2024-03-02"),
        issue("2", project="p9"), issue("3", severity=None), issue("4", project=None, kind="odd"),
        issue("5", when=None, house="h5"), issue("6", house=None), issue(None),
    ), sites, homes, tables)
    assert reasons(report) == [
        ("4", "missing project_id"), ("5", "missing updated_at"), ("6", "missing property_id"),
        (None, "missing issue_id")]
    fact = named_fact(tables, "fact_issues", severity_key=("dim_severity", "severity_key",
                                                           "severity"),
                      project_key=("d_project", "project_key", "project_id"))
    assert rows(fact, "issue_id", "severity_key_name", "project_key_name",
                "updated_date_key") == [
        ("1", "low", "p1", 20240302), ("2", "high", "p9", 20240301), ("3", None, "p1", 20240301)]
    assert members(tables, "dim_severity") == [("high",), ("low",)]
    assert members(tables, "dim_issue_type") == [("leak",), ("odd",)]
    assert members(tables, "d_project") == [("p1", "Site 1"), ("p9", None)]
    assert members(tables, "d_property") == [("h1", "House 1", None, None),
                                             ("h5", None, None, None)]

    # A project gone from the source loses its name; a budget set elsewhere stays.
    tables.replace("d_property", tables.read("d_property").withColumn(
        "budget", F.lit(7).cast("decimal(38,6)")))
    issues.load(frame(spark, ISSUES, issue("1")), frame(spark, PROJECTS), homes, tables)
    assert members(tables, "d_project") == [("p1", None), ("p9", None)]
    assert members(tables, "d_property")[0] == ("h1", "House 1", 7.0, None)
    assert rows(tables.read("fact_issues"), "issue_id", "updated_date_key")[0] == ("1", 20240301)


# Worker payments


def known_days(spark, *days):
    return frame(spark, "date_key int, full_date date",
                 *[(int(d.replace("-", "")), day(d)) for d in days])


def test_worker_payments(spark):
    tables = session_tables(spark, core_dim_date=known_days(spark, "2024-04-01", "2024-04-02"))
    worker_payments.load(frame(
        spark, PAYMENTS, worker_payment("1", "w1", "Old Name", "due", "u@x", "2024-04-01T08:00:00"),
        worker_payment("2", "w1", "New Name", "due", None, "2024-04-02"),
        worker_payment("3", None, "Nobody", None, "u@x", "2024-04-02"),
        worker_payment(None, "w2", "Two", "due", "u@x", "2024-04-02"),
        worker_payment("1", "w1", "New Name", "paid", "u@x", "2024-04-02", gross="12.5"),
    ), tables)
    assert members(tables, "core_dim_worker") == [("w1", "New Name", "mason")]
    assert members(tables, "core_dim_status") == [("due",), ("paid",)]
    fact = named_fact(
        tables, "fact_worker_payments", worker_key=("core_dim_worker", "worker_key", "worker_id"),
        status_key=("core_dim_status", "status_key", "status_name"),
        created_by_key=("core_dim_user", "user_key", "user_email"))
    assert rows(fact, "payment_id", "worker_key_name", "status_key_name", "created_by_key_name",
                "gross_amount", "created_date_key") == [
        ("1", "w1", "paid", "u@x", 12.5, 20240402), ("2", "w1", "due", None, 10.0, 20240402),
        ("3", None, None, "u@x", 10.0, 20240402)]


@pytest.mark.parametrize("when", ["2024-04-03", None])
def test_worker_payments_need_every_date(spark, when):
    tables = session_tables(spark, core_dim_date=known_days(spark, "2024-04-01"))
    batch = frame(spark, PAYMENTS, worker_payment("1", "w1", "A", "due", "u", "2024-04-01"),
                  worker_payment("2", "w2", "B", "due", "u", when))
    with pytest.raises(UnknownMember, match=when or "None"):
        worker_payments.load(batch, tables)
    assert not tables.exists("core_dim_worker") and not tables.exists("fact_worker_payments")


# Payloads


def record(number="1", item="nail", quantity="5", place="north", when='"2025-07-01"'):
    return (f'{{"request_id": "{number}", "item_name": "{item}", "quantity": {quantity}, '
            f'"location": "{place}", "requested_date": {when}}}')


def payload_frame(spark, folder, *documents):
    folder.mkdir(exist_ok=True)
    for i, text in enumerate(documents):
        (folder / f"{i:03d}.json").write_text(text)
    return read_payloads(spark, str(folder))


def test_payload_records(spark, tmp_path):
    listed = [
        record("1"), record("2", quantity="0"), record("3", quantity='"0"'),
        record("4", when='"2025-7-1"'), record("5", when='"2025-13-01"'),
        record("6", when='"2025-02-29"'), record("7", when='"2025-007-01"'),
        record("8", when='"2025-07-01x"'), record("9", quantity="false"),
        record("10", quantity="null"), record("11", quantity="0.0"), record("12", quantity='""'),
        "5", "null", record("13", when="20250701"), record("1", quantity="6", item="bolt"),
        record("14", quantity='"many"', item="cog"), record("15", quantity="true"),
        record("16", quantity="[1]"), '{"request_id": "17"}',
        '{"request_id": "18", "item_name": ["a"], "quantity": 1, "location": "x", '
        '"requested_date": "2025-07-02"}',
        '{"request_id": {"a": 1}, "item_name": "pin", "quantity": 1, "location": "x", '
        '"requested_date": "2025-07-03"}',
        '{"request_id": 19, "item_name": "nail", "quantity": 1.25, "location": "north", '
        '"requested_date": "2025-07-01", "more": {}}',
    ]
    documents = payload_frame(
        spark, tmp_path / "in", '{"records": [\n' + ",\n".join(listed) + "]}",
        "{}", '{"records": []}', '{"records": 5}', '{"records": null}', "not json")
    tables = session_tables(spark)
    report = payload.load(documents, tables)
    assert rows(tables.read("f_inventory_requests"), "request_id", "quantity") == [
        ("1", 6.0), ("19", 1.25), ("3", 0.0), ("4", 5.0)]
    by_reason = {}
    for key, reason in reasons(report):
        by_reason.setdefault(reason, []).append(key)
    assert by_reason == {
        "incomplete": ["10", "11", "12", "17", "2", "9"],
        "bad requested_date": ["13", "5", "6", "7", "8"], "not an object": [None, None],
        "bad quantity": ["14", "15", "16"], "bad item_name": ["18"],
        "bad request_id": ['{"a":1}'],
        "unreadable payload": [f"file:{tmp_path}/in/005.json"],
    }
    assert members(tables, "d_item") == [("bolt",), ("cog",), ("nail",), ("pin",)]
    assert rows(tables.read("d_date"), "date_key") == [
        (20250701,), (20250702,), (20250703,)]


@pytest.mark.parametrize("text", ["{}", '{"records": []}', '{"records": 5}', '{"records": {}}'])
def test_payload_without_records(spark, tmp_path, text):
    tables = session_tables(spark)
    payload.load(payload_frame(spark, tmp_path / "in", text), tables)
    assert tables.read("f_inventory_requests").count() == 0


def test_last_of_repeated_fields_counts(spark, tmp_path):
    tables = session_tables(spark)
    text = record("1").replace('"quantity": 5', '"quantity": 0, "quantity": 8')
    payload.load(payload_frame(spark, tmp_path / "in", f'{{"records": [{text}]}}'), tables)
    assert rows(tables.read("f_inventory_requests"), "quantity") == [(8.0,)]


def test_conform_adds_absent_columns(spark):
    got = conform(frame(spark, "project_id string", ("a",)), "d_project")
    assert got.dtypes == [("project_key", "bigint"), ("project_id", "string"),
                          ("project_name", "string")]
