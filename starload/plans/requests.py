"""Inventory requests: three dimensions, then requests not stored yet."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.functions.dates import date_key
from starload.functions.text import nonblank, present
from starload.operators import clean, dims, lookup
from starload.operators.lookup import Lookup
from starload.operators.merge import first_wins, total_order
from starload.plans.report import Report
from starload.schemas import TABLES
from starload.session import materialize
from starload.sources.scan import project

# Tables a first load finds missing and creates.
CREATED = (
    "d_employees", "d_item_type", "d_request_status", "d_item",
    "d_project", "d_property", "fact_inventory_requests",
)

EMPLOYEE = {
    "emp_id": "employee_code", "first_name": "first_name", "last_name": "last_name",
    "email": "email",
}
REQUEST = {
    "request_id": "request_id", "property_name": "property_name",
    "project_name": "project_name", "item_name": "item_name", "item_type": "item_type",
    "quantity": "requested_quantity", "status": "status", "created_at": "created_at",
    "updated_at": "updated_at",
}
REQUIRED = ("request_id", "property_name", "project_name", "item_name", "item_type", "status")
# Dimensions cleared of blank members, with the column that must not be blank.
PURGED = {
    "d_item_type": "item_type", "d_request_status": "status_name", "d_item": "item_name",
    "d_project": "project_name", "d_property": "property_name",
}


def employees(source: DataFrame) -> DataFrame:
    """Distinct employees."""
    return project(source, EMPLOYEE).distinct()


def referring_facts(tables, dimension: str) -> list[tuple[DataFrame, str]]:
    """Existing facts that refer to a dimension, with the column they do it by."""
    return [
        (tables.read(fact.name), column)
        for fact in TABLES.values() if fact.fact and tables.exists(fact.name)
        for column, (target, _) in fact.references.items() if target == dimension
    ]


def purge_blanks(tables) -> dict[str, DataFrame]:
    """Drop blank members no fact refers to; returns those that were found."""
    read = {name: tables.read(name) for name in PURGED}
    # One job looks for blanks in all dimensions.
    asked = functools.reduce(DataFrame.unionByName, [
        read[name].filter(~nonblank(F.col(column))).select(F.lit(name).alias("dim"))
        for name, column in PURGED.items()
    ])
    held = {r["dim"] for r in asked.distinct().collect()}
    found = {}
    for name, column in PURGED.items():
        if name not in held:
            continue
        dimension = read[name]
        blanks = dims.blank_members(dimension, name, column, referring_facts(tables, name))
        found[name] = blanks
        tables.replace(name, dims.purge(dimension, name, blanks))
    return found


def load_dimensions(staff: DataFrame, requests: DataFrame, tables) -> dict[str, DataFrame]:
    tables.append("d_employees", dims.first_seen(
        employees(staff), "d_employees", tables.read("d_employees"), top=tables.top("d_employees")))
    type_, status = F.col("item_type"), F.col("status")
    values = {
        ("d_item_type", "item_type"): F.when(nonblank(type_), type_),
        ("d_request_status", "status_name"): F.when(nonblank(status), status),
    }
    dims.insert_members(dims.offers(requests, values), values, tables)
    return purge_blanks(tables)


def check(requests: DataFrame) -> DataFrame:
    """Requests with date keys; incomplete ones are marked. Quantity may be absent."""
    rows = project(requests, REQUEST)
    return clean.classify(
        rows.withColumn("raised_date_key", date_key(F.col("created_at")))
        .withColumn("updated_date_key", date_key(F.col("updated_at"))),
        [
            ("incomplete", F.coalesce(*[F.when(~present(F.col(c)), False) for c in REQUIRED],
                                      F.lit(True))),
        ],
    )


def resolve(checked: DataFrame, tables) -> DataFrame:
    """All requests with keys, or with the first member that is unknown."""
    projects = lookup.by_name(tables.read("d_project"), "project_name", "project_key")
    properties = lookup.by_name(tables.read("d_property"), "property_name", "property_key")
    found = lookup.or_reject(checked, [
        Lookup("status", tables.read("d_request_status"), "status_name", "status_key",
               "request_status_key"),
        Lookup("item_type", tables.read("d_item_type"), "item_type", "item_type_key",
               "item_type_key"),
        Lookup("project_name", projects, "project_name", "project_key", "project_key"),
        Lookup("property_name", properties, "property_name", "property_key", "property_key"),
        Lookup("item_name", tables.read("d_item"), "item_name", "item_key", "item_key"),
    ])
    return clean.classify(found, [("bad quantity", clean.fits_amount(found, "quantity"))])


def facts(resolved: DataFrame) -> DataFrame:
    """The first request of each id, in fact columns."""
    rows = clean.kept(resolved, *REQUIRED)
    order = total_order(rows.select(*REQUEST), ["updated_at"], ["request_id"])
    first = first_wins(rows, ["request_id"], order)
    return first.withColumn("status", F.col("request_status_key"))


def load(staff: DataFrame, requests: DataFrame, tables) -> Report:
    tables.create(*CREATED)
    blanks = load_dimensions(staff, requests, tables)
    checked = check(requests)
    # Written once: the fact, the rejects and the counts read it.
    resolved = materialize(resolve(checked, tables), "requests")
    merged = tables.insert_absent("fact_inventory_requests", facts(resolved))
    return Report("requests", "request_id", resolved, merged, blanks)
