"""Worker payments: every date must be known, or nothing is loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.operators import clean, dims, lookup
from starload.operators.lookup import Lookup
from starload.operators.merge import last_wins, total_order
from starload.plans.report import Report

# Tables a first load finds missing and creates.
CREATED = ("core_dim_worker", "core_dim_status", "core_dim_user", "fact_worker_payments")

AMOUNTS = (
    "total_hours_worked", "total_sqft_completed", "total_days", "gross_amount", "tds_percent",
    "tds_amount", "net_amount",
)
SOURCE = (
    "payment_id", "worker_id", "worker_name", "worker_type", "work_duration_type", *AMOUNTS,
    "payment_mode", "status", "created_by", "created_at",
)


class BadAmount(ValueError):
    """An amount no target column can hold."""


def check(payments: DataFrame) -> DataFrame:
    """Payments that have an id, with their date."""
    rows = clean.required(payments.select(*SOURCE), "payment_id")
    rows = rows.withColumn("created_date", F.to_date("created_at"))
    return clean.classify(rows, [(f"bad {c}", clean.fits_amount(rows, c)) for c in AMOUNTS])


def created_date(tables) -> Lookup:
    return Lookup(
        "created_date", tables.read("core_dim_date"), "full_date", "date_key", "created_date_key"
    )


def load_dimensions(checked: DataFrame, tables) -> None:
    attributes = ["worker_name", "worker_type"]
    dims.overwrite_members(
        checked.select("created_at", "worker_id", *attributes, "payment_id"), "core_dim_worker",
        tables, attributes, ["created_at"],
    )
    values = {
        ("core_dim_status", "status_name"): F.col("status"),
        ("core_dim_user", "user_email"): F.col("created_by"),
    }
    dims.insert_members(dims.offers(checked, values), values, tables)


def resolve(checked: DataFrame, tables) -> DataFrame:
    """One row per payment with its keys; the dates are known to be found."""
    rows = clean.kept(checked)
    found = lookup.or_null(rows, [
        created_date(tables),
        Lookup("worker_id", tables.read("core_dim_worker"), "worker_id", "worker_key",
               "worker_key"),
        Lookup("status", tables.read("core_dim_status"), "status_name", "status_key",
               "status_key"),
        Lookup("created_by", tables.read("core_dim_user"), "user_email", "user_key",
               "created_by_key"),
    ])
    order = total_order(rows, ["created_at"], ["payment_id", "created_date"])
    return last_wins(found, ["payment_id"], order)


def load(payments: DataFrame, tables) -> Report:
    """Dates and amounts are checked before anything is written."""
    checked = check(payments)
    bad = clean.rejects(checked, "worker_payments", "payment_id").first()
    if bad:
        raise BadAmount(f"payment {bad['key']}: {bad['reason']}")
    lookup.or_fail(checked, created_date(tables))
    tables.create(*CREATED)
    load_dimensions(checked, tables)
    merged = tables.upsert("fact_worker_payments", resolve(checked, tables))
    return Report("worker_payments", "payment_id", checked, merged)
