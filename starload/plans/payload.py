"""Requests pushed as JSON records; the last record of a request wins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.functions.dates import strict_date
from starload.functions.text import decimals
from starload.functions.truth import is_scalar, truthy
from starload.operators import clean, dims, lookup
from starload.operators.lookup import Lookup
from starload.operators.merge import last_wins
from starload.plans.inventory import item_and_project
from starload.plans.report import Report
from starload.schemas import AMOUNT
from starload.sources.payload import records
from starload.session import materialize

# Tables a first load finds missing and creates.
CREATED = ("d_date", "d_item", "d_project", "f_inventory_requests")

FIELDS = ("request_id", "item_name", "quantity", "location", "requested_date")


def check(payloads: DataFrame) -> DataFrame:
    """One row per record with typed columns and the reason of rejection."""
    fields = records(payloads).select(
        "arrival", "position", "unreadable", "record",
        *[F.try_variant_get("record", f"$.{f}", "variant").alias(f"_{f}") for f in FIELDS],
    )
    # Kinds and texts are taken out once. The rules over them must stay small: Java runs code
    # beyond 8,000 bytes without compiling it.
    raw = fields.select(
        "*", *[F.schema_of_variant(f"_{f}").alias(f"_kind_{f}") for f in FIELDS],
        *[F.try_variant_get(f"_{f}", "$", "string").alias(f"_text_{f}") for f in FIELDS],
    )
    raw = raw.withColumn("_number", F.when(
        F.col("_kind_quantity").rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|STRING)"), F.col("_text_quantity")))
    kind, text = ({f: F.col(f"_{what}_{f}") for f in FIELDS} for what in ("kind", "text"))
    # What has a field is an object; the schema of a whole record is asked for only without one.
    is_object = F.when(F.coalesce(*kind.values()).isNotNull(), True).otherwise(
        F.schema_of_variant("record").startswith("OBJECT"))
    complete = F.lit(True)
    for f in FIELDS:
        complete = complete & truthy(F.col(f"_{f}"), kind[f], text[f])
    number = F.col("_number")
    amount = F.when(decimals(number) <= AMOUNT.scale, number.try_cast(AMOUNT))
    date = F.when(kind["requested_date"] == "STRING", strict_date(text["requested_date"]))
    scalar = {f: is_scalar(F.col(f"_{f}"), kind[f]) for f in FIELDS}
    return clean.classify(
        raw.withColumn("quantity", amount).withColumn("date", date)
        .withColumn("request_id", F.when(F.col("unreadable"), F.col("arrival.path"))
                    .otherwise(text["request_id"]))
        .withColumn("item_name", text["item_name"])
        .withColumn("location", text["location"]),
        [
            ("unreadable payload", ~F.col("unreadable")),
            ("not an object", is_object),
            ("incomplete", complete),
            ("bad requested_date", F.col("date").isNotNull()),
            ("bad item_name", scalar["item_name"]),
            ("bad location", scalar["location"]),
            ("bad request_id", scalar["request_id"]),
            ("bad quantity", F.col("quantity").isNotNull()),
        ],
    ).select(
        "arrival", "position", "request_id", "item_name", "quantity", "location", "date",
        clean.REASON,
    )


def load_dimensions(checked: DataFrame, tables) -> None:
    """A record refused for its id or quantity still adds its members."""
    reason = F.coalesce(F.col(clean.REASON), F.lit(""))
    dated = F.col("date").isNotNull() & ~reason.isin(
        "unreadable payload", "not an object", "incomplete", "bad requested_date"
    )
    itemed = dated & (reason != "bad item_name")
    placed = itemed & (reason != "bad location")
    values = {
        ("d_date", "date"): F.when(dated, F.col("date")),
        ("d_item", "item_name"): F.when(itemed, F.col("item_name")),
        ("d_project", "project_name"): F.when(placed, F.col("location")),
    }
    dims.insert_members(dims.offers(checked, values), values, tables)


def resolve(checked: DataFrame, tables) -> DataFrame:
    """One row per request with its keys."""
    rows = clean.kept(checked, "request_id", "date")
    dated = Lookup("date", tables.read("d_date"), "date", "date_key", "date_key")
    found = lookup.or_null(rows, [dated, *item_and_project(tables)])
    return last_wins(found, ["request_id"], ["arrival", "position"])


def load(payloads: DataFrame, tables) -> Report:
    tables.create(*CREATED)
    # Parsed once; the typed records feed three dimensions and the fact.
    checked = materialize(check(payloads), "payload")
    load_dimensions(checked, tables)
    merged = tables.upsert("f_inventory_requests", resolve(checked, tables))
    return Report("payload", "request_id", checked, merged)
