"""Property schedules: a four-way extract, overwritten attributes, upserted fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.functions.dates import date_key
from starload.operators import clean, dims, lookup
from starload.operators.lookup import Lookup
from starload.operators.merge import last_wins, total_order
from starload.plans.report import Report
from starload.session import materialize

# Tables a first load finds missing and creates.
CREATED = ("d_date", "d_project", "d_property", "d_phase", "d_status", "f_property_schedule")

# Read order of the extract. Project and property columns come right after the
# start date: all rows of a property and start date meet every version of these,
# so the winning version follows from the distinct versions alone.
ORDER = ("property_id", "startdate", "project_name", "property_name", "budget", "usedbudget")


def extract(
    property_schedule: DataFrame, schedule: DataFrame, properties: DataFrame, projects: DataFrame
) -> DataFrame:
    """Schedules of live property schedules with their property and project."""
    live = clean.live(property_schedule, "is_deleted")
    return (
        live.join(schedule, "propertyscheduleid")
        .join(properties, "propertyid")
        .join(projects, F.col("projectid") == F.col("project_id"))
        .select(
            F.col("propertyid").alias("property_id"), "project_id", "project_name",
            F.col("name").alias("property_name"), "budget", "usedbudget", "scheduleid",
            "phasename", "startdate", "enddate", "status", "percentage",
        )
    )


def check(extracted: DataFrame) -> DataFrame:
    """Rows with date keys, NULL where a date is, and the reason of rejection."""
    rows = extracted.withColumn("start_date_key", date_key(F.col("startdate"))).withColumn(
        "end_date_key", date_key(F.col("enddate"))
    )
    return clean.classify(rows, [
        ("bad budget", clean.fits_amount(rows, "budget", "usedbudget")),
        ("missing phasename", F.col("phasename").isNotNull()),
        ("missing status", F.col("status").isNotNull()),
        ("missing scheduleid", F.col("scheduleid").isNotNull()),
        ("bad percentage", clean.fits_amount(rows, "percentage")),
    ])


def load_dimensions(checked: DataFrame, tables) -> None:
    """Rows rejected later still add dates and refresh project and property."""
    projects = checked.select("project_id", "project_name").distinct()
    dims.overwrite_members(projects, "d_project", tables, ["project_name"], ["project_name"])
    attributes = ["property_name", "budget", "usedbudget"]
    sound = clean.fits_amount(checked, "budget", "usedbudget")
    properties = checked.filter(sound).select("property_id", "project_name", *attributes).distinct()
    dims.overwrite_members(
        properties, "d_property", tables, attributes, ["project_name", *attributes])
    phase = F.when(sound, F.col("phasename"))
    values = {
        ("d_date", "date"): [F.col("startdate"), F.col("enddate")],
        ("d_phase", "phase_name"): phase,
        ("d_status", "status_name"): F.when(phase.isNotNull(), F.col("status")),
    }
    dims.insert_members(dims.offers(checked, values), values, tables)


def resolve(checked: DataFrame, tables) -> DataFrame:
    """One row per schedule with its keys."""
    rows = clean.kept(checked, "scheduleid", "phasename", "status")
    found = lookup.or_null(rows, [
        Lookup("project_id", tables.read("d_project"), "project_id", "project_key", "project_key"),
        Lookup("property_id", tables.read("d_property"), "property_id", "property_key",
               "property_key"),
        Lookup("phasename", tables.read("d_phase"), "phase_name", "phase_key", "phase_key"),
        Lookup("status", tables.read("d_status"), "status_name", "status_key", "status_key"),
    ])
    order = total_order(rows, ORDER, ["scheduleid", "start_date_key", "end_date_key"])
    return last_wins(found, ["scheduleid"], order)


def load(
    property_schedule: DataFrame, schedule: DataFrame, properties: DataFrame,
    projects: DataFrame, tables,
) -> Report:
    tables.create(*CREATED)
    # The extract feeds five dimensions and the fact, so it is joined once.
    extracted = extract(property_schedule, schedule, properties, projects)
    checked = check(materialize(extracted, "schedule"))
    load_dimensions(checked, tables)
    merged = tables.upsert("f_property_schedule", resolve(checked, tables))
    return Report("schedule", "scheduleid", checked, merged)
