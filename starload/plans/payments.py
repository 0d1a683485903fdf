"""Invoices matched to vendors by name; a stored payment is never refreshed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.operators import clean, dims, lookup
from starload.operators.fuzzy import fuzzy_join
from starload.operators.lookup import Lookup
from starload.operators.merge import first_wins, total_order
from starload.plans.report import Report
from starload.schemas import TABLES
from starload.session import materialize

# Tables a first load finds missing and creates.
CREATED = ("d_date", "d_invoice", "d_vendor", "f_payments")

AMOUNTS = ("amount_to_pay", "paid_amount", "overdue_amount", "taxes_sgst", "taxes_cgst")
INVOICE = (
    "avenue_created_invoice_id", "supplier_name", "created_date", "total_bill_amount", *AMOUNTS,
    "taxes_igst", "taxes_gst_percentage",
)


def readable(invoices: DataFrame, *others: str) -> DataFrame:
    """Invoices with an id, a date and a supplier."""
    return clean.required(
        invoices.select(*INVOICE, *others), "avenue_created_invoice_id", "created_date", "supplier_name"
    )


def extract(invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    """One row per invoice and matching vendor."""
    matched = fuzzy_join(
        readable(invoices), vendors.select("vendor_id", "vendor_name"),
        "supplier_name", "vendor_name",
    )
    return matched.select(
        F.col("avenue_created_invoice_id").alias("invoice_id"), "vendor_id", "vendor_name",
        "created_date", "total_bill_amount", *AMOUNTS, "taxes_igst", "taxes_gst_percentage",
    )


def check(extracted: DataFrame) -> DataFrame:
    rows = extracted.withColumn("date", F.to_date("created_date"))
    return clean.classify(rows, [
        ("missing vendor_id", F.col("vendor_id").isNotNull()),
        *[(f"bad {c}", clean.fits_amount(rows, c)) for c in AMOUNTS],
    ])


def load_dimensions(checked: DataFrame, tables, few: dict[str, list] | None = None) -> None:
    values = {("d_date", "date"): F.col("date"), ("d_invoice", "invoice_id"): F.col("invoice_id")}
    dims.insert_members(dims.offers(checked, values), values, tables,
                        few and {"d_invoice": few["invoice_id"]})
    seen = checked.select("created_date", "invoice_id", "vendor_id", "vendor_name")
    stored = dims.stored_members(tables, "d_vendor", "vendor_id", few and few["vendor_id"])
    tables.append(
        "d_vendor",
        dims.first_seen(seen, "d_vendor", stored, ["created_date", "invoice_id"], tables.top("d_vendor")),
    )


def resolve(checked: DataFrame, tables, few: dict[str, list] | None = None) -> DataFrame:
    """The first row per vendor, invoice and date, with its keys."""
    rows = clean.kept(checked, "vendor_id")
    vendors = tables.members("d_vendor", "vendor_id", few and few["vendor_id"])
    invoices = tables.members("d_invoice", "invoice_id", few and few["invoice_id"])
    found = lookup.or_null(rows, [
        Lookup("vendor_id", vendors, "vendor_id", "vendor_key", "vendor_key"),
        Lookup("invoice_id", invoices, "invoice_id", "invoice_key", "invoice_key"),
        Lookup("date", tables.read("d_date"), "date", "date_key", "date_key"),
    ])
    order = total_order(rows, ["created_date"], ["vendor_id", "invoice_id", "date"])
    return first_wins(found, TABLES["f_payments"].natural, order)


def load(invoices: DataFrame, vendors: DataFrame, tables) -> Report:
    tables.create(*CREATED)
    # The match feeds three dimensions and the fact, so it is joined once.
    checked = check(materialize(extract(invoices, vendors), "payments"))
    few = lookup.few_values(tables, checked, "vendor_id", "invoice_id")
    load_dimensions(checked, tables, few)
    merged = tables.insert_absent("f_payments", resolve(checked, tables, few))
    return Report("payments", "invoice_id", checked, merged)
