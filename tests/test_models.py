"""Loads against the same rules played row by row, on random rows."""

import itertools
import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest

from helpers import (
    INVENTORY, INVOICES, ISSUES, PROJECTS, PROPERTIES, PROPERTY_SCHEDULE, SCHEDULE, VENDORS,
    frame, named_fact, rows, session_tables,
)
from starload.plans import inventory, issues, payments, schedule
from test_fuzzy import matches


def nulls_last(values):
    return tuple((v is None, 0 if v is None else v) for v in values)


def moment(pick):
    return datetime(2024, 1, 1) + timedelta(hours=pick.randrange(60))


@pytest.mark.parametrize("seed, parts", [(1, 1), (2, 3), (3, 7)])
def test_inventory(spark, seed, parts):
    pick = random.Random(seed)
    source = [
        (str(pick.randrange(15)), pick.choice(["a", "b", "", None, "c"]),
         Decimal(pick.randrange(3)), pick.choice(["n", "s", None]),
         pick.choice([None, *[moment(pick) for _ in range(9)]]))
        for _ in range(120)
    ]
    stored, items, places, days = {}, set(), set(), set()
    order = sorted(source, key=lambda r: nulls_last((r[4], r[0], r[1], r[2], r[3])))
    for number, item, quantity, place, when in order:
        if when is None:
            continue
        days.add(when.date())
        if item is None:
            continue
        items.add(item)
        if place is None:
            continue
        places.add(place)
        stored[number] = (number, item, float(quantity), place, int(when.strftime("%Y%m%d")))

    tables = session_tables(spark)
    inventory.load(frame(spark, INVENTORY, *source).repartition(parts), tables)
    fact = named_fact(tables, "f_inventory", item_key=("d_item", "item_key", "item_name"),
                      project_key=("d_project", "project_key", "project_name"))
    got = rows(fact, "inventory_id", "item_key_name", "quantity", "project_key_name", "date_key")
    assert got == sorted(stored.values(), key=repr)
    # Keys follow the order of the members, however the rows were spread.
    assert rows(tables.read("d_item"), "item_key", "item_name") == sorted(
        enumerate(sorted(items), 1), key=repr)
    assert {r[0] for r in rows(tables.read("d_project"), "project_name")} == places
    assert {r[0] for r in rows(tables.read("d_date"), "date")} == days


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_schedule_with_repeated_properties_and_projects(spark, seed):
    """Also where a property or project comes in several versions."""
    pick = random.Random(seed)
    homes = [
        (f"h{i}", f"p{pick.randrange(3)}", f"home {pick.randrange(4)}",
         pick.choice([None, Decimal(pick.randrange(4))]), None)
        for i in range(5) for _ in range(pick.choice([1, 1, 2]))
    ]
    sites = [(f"p{i}", pick.choice([None, f"site {pick.randrange(5)}"]))
             for i in range(3) for _ in range(pick.choice([1, 2]))]
    live = [(i, f"h{pick.randrange(6)}", pick.choice([False, False, True, None]))
            for i in range(12)]
    plan = [
        (pick.randrange(20), pick.randrange(14), pick.choice(["dig", "build", None]),
         pick.choice([None, date(2024, 1, 1 + pick.randrange(5))]), None,
         pick.choice(["open", "done", None]), Decimal(pick.randrange(3)))
        for _ in range(60)
    ]
    joined = [
        (h[0], s[0], s[1], h[2], h[3], h[4], *x)
        for l, x, h, s in itertools.product(live, plan, homes, sites)
        if l[2] is False and l[0] == x[1] and l[1] == h[0] and h[1] == s[0]
    ]
    order = sorted(joined, key=lambda r: nulls_last((r[0], r[9], r[2], r[3], r[4], r[5], r[1],
                                                     r[6], r[8], r[10], r[11], r[12])))
    projects, properties, fact = {}, {}, {}
    for (home, site, site_name, name, budget, used, number, _, phase, start, end, status,
         percent) in order:
        projects[site] = site_name
        properties[home] = (name, None if budget is None else float(budget), used)
        if phase is None or status is None:
            continue
        fact[number] = (number, home, site, phase, status,
                        int(start.strftime("%Y%m%d")) if start else None, float(percent))

    tables = session_tables(spark)
    schedule.load(frame(spark, PROPERTY_SCHEDULE, *live), frame(spark, SCHEDULE, *plan),
                  frame(spark, PROPERTIES, *homes), frame(spark, PROJECTS, *sites), tables)
    assert dict(rows(tables.read("d_project"), "project_id", "project_name")) == projects
    got = rows(tables.read("d_property"), "property_id", "property_name", "budget", "usedbudget")
    assert {r[0]: r[1:] for r in got} == properties
    named = named_fact(
        tables, "f_property_schedule", property_key=("d_property", "property_key", "property_id"),
        project_key=("d_project", "project_key", "project_id"),
        phase_key=("d_phase", "phase_key", "phase_name"),
        status_key=("d_status", "status_key", "status_name"))
    assert rows(named, "scheduleid", "property_key_name", "project_key_name", "phase_key_name",
                "status_key_name", "start_date_key", "percentage") == sorted(
        fact.values(), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_issues_with_repeated_names(spark, seed):
    pick = random.Random(seed)
    source = [
        (f"t{pick.randrange(12)}", pick.choice([None, "p0", "p1", "p2", "p9"]),
         pick.choice([None, "h0", "h1", "h9"]), pick.choice([None, "r@x", "s@x"]),
         pick.choice(["leak", "noise"]), pick.choice([None, "high"]), "P1",
         pick.choice(["open", "closed"]), pick.choice([None, moment(pick), moment(pick)]))
        for _ in range(80)
    ]
    sites = [("p0", "Zero"), ("p1", "One"), ("p1", "Uno"), ("p2", None)]
    homes = [("h0", "p0", "Home", None, None), ("h1", "p1", "A", None, None),
             ("h1", "p1", "B", None, None)]
    joined = [
        (*x, s, h) for x in source
        for s in ([n for i, n in sites if i == x[1]] or [None])
        for h in ([r[2] for r in homes if r[0] == x[2]] or [None])
    ]
    order = sorted(joined, key=lambda r: nulls_last(
        (r[8], r[0], r[1], r[2], r[4], r[5], r[6], r[7], r[3], r[9], r[10])))
    projects, properties, fact = {}, {}, {}
    for number, site, home, mail, kind, severity, _, status, when, name, house in order:
        if site is None:
            continue
        projects[site] = name
        if home is None:
            continue
        properties[home] = house
        if when is not None:
            fact[number] = (number, site, home, kind, severity, status, mail,
                            int(when.strftime("%Y%m%d")))

    tables = session_tables(spark)
    issues.load(frame(spark, ISSUES, *source), frame(spark, PROJECTS, *sites),
                frame(spark, PROPERTIES, *homes), tables)
    assert dict(rows(tables.read("d_project"), "project_id", "project_name")) == projects
    assert dict(rows(tables.read("d_property"), "property_id", "property_name")) == properties
    named = named_fact(
        tables, "fact_issues", project_key=("d_project", "project_key", "project_id"),
        property_key=("d_property", "property_key", "property_id"),
        issue_type_key=("dim_issue_type", "issue_type_key", "issue_type"),
        severity_key=("dim_severity", "severity_key", "severity"),
        status_key=("dim_status", "status_key", "status"),
        reporter_key=("dim_reporter", "reporter_key", "reported_by_email"))
    assert rows(named, "issue_id", "project_key_name", "property_key_name",
                "issue_type_key_name", "severity_key_name", "status_key_name",
                "reporter_key_name", "updated_date_key") == sorted(fact.values(), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_payments(spark, seed):
    pick = random.Random(seed)

    def name():
        return pick.choice(["acme", "Acme Steel", "steel", "a_me", "other", "", None, "50%"])

    vendors = [(f"v{pick.randrange(5)}", name()) for _ in range(7)]
    source = [
        (pick.choice([None, "i1", "i2", "i3"]), name(), pick.choice([None, moment(pick)]),
         str(pick.randrange(3)), Decimal(pick.randrange(3)), None, None, None, None, "x", "y")
        for _ in range(60)
    ]
    joined = sorted(
        ((b[2], b[0], v[0], v[1], b[3], b[4]) for b in source for v in vendors
         if None not in (b[0], b[1], b[2], v[1]) and matches(b[1], v[1])), key=nulls_last)
    seen, fact = {}, {}
    for when, number, vendor, label, bill, amount in joined:
        seen.setdefault(vendor, label)
        fact.setdefault((vendor, number, int(when.strftime("%Y%m%d"))), (bill, float(amount)))

    tables = session_tables(spark)
    payments.load(frame(spark, INVOICES, *source), frame(spark, VENDORS, *vendors), tables)
    assert dict(rows(tables.read("d_vendor"), "vendor_id", "vendor_name")) == seen
    named = named_fact(tables, "f_payments", vendor_key=("d_vendor", "vendor_key", "vendor_id"),
                       invoice_key=("d_invoice", "invoice_key", "invoice_id"))
    got = rows(named, "vendor_key_name", "invoice_key_name", "date_key", "total_bill_amount",
               "amount_to_pay")
    assert got == sorted(((*k, *v) for k, v in fact.items()), key=repr)
    assert tables.read("f_payments").select("payment_key").distinct().count() == len(fact)
