"""Stock snapshot: latest state per inventory id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.operators import clean, dims, lookup
from starload.operators.lookup import Lookup
from starload.operators.merge import last_wins, total_order
from starload.plans.report import Report

# Tables a first load finds missing and creates.
CREATED = ("d_date", "d_item", "d_project", "f_inventory")

SOURCE = ("inventory_id", "item_name", "quantity", "location", "updated_date")


def check(inventory: DataFrame) -> DataFrame:
    """Source rows with the first reason they are rejected for."""
    rows = inventory.select(*SOURCE).withColumn("date", F.to_date("updated_date"))
    return clean.classify(rows, [
        ("missing updated_date", F.col("date").isNotNull()),
        ("missing item_name", F.col("item_name").isNotNull()),
        ("missing location", F.col("location").isNotNull()),
        ("missing inventory_id", F.col("inventory_id").isNotNull()),
        ("bad quantity", clean.fits_amount(rows, "quantity")),
    ])


def load_dimensions(checked: DataFrame, tables) -> None:
    """A row rejected at a later step still adds the members of earlier steps."""
    dated = F.col("date").isNotNull()
    itemed = dated & F.col("item_name").isNotNull()
    values = {
        ("d_date", "date"): F.col("date"),
        ("d_item", "item_name"): F.when(dated, F.col("item_name")),
        ("d_project", "project_name"): F.when(itemed, F.col("location")),
    }
    dims.insert_members(dims.offers(checked, values), values, tables)


def item_and_project(tables) -> list[Lookup]:
    """The lookups by item name and, as names may repeat, by lowest project key."""
    projects = lookup.by_name(tables.read("d_project"), "project_name", "project_key")
    return [
        Lookup("item_name", tables.read("d_item"), "item_name", "item_key", "item_key"),
        Lookup("location", projects, "project_name", "project_key", "project_key"),
    ]


def resolve(checked: DataFrame, tables) -> DataFrame:
    """One row per inventory id with its keys."""
    rows = clean.kept(checked, "inventory_id", "item_name", "location", "updated_date")
    dated = Lookup("date", tables.read("d_date"), "date", "date_key", "date_key")
    found = lookup.or_null(rows, [dated, *item_and_project(tables)])
    # The reduction comes last: its shuffle is the one the fact is written by.
    order = total_order(rows, ["updated_date"], ["inventory_id", "date"])
    return last_wins(found, ["inventory_id"], order)


def load(inventory: DataFrame, tables) -> Report:
    tables.create(*CREATED)
    checked = check(inventory)
    load_dimensions(checked, tables)
    merged = tables.upsert("f_inventory", resolve(checked, tables))
    return Report("inventory", "inventory_id", checked, merged)
