"""Issue tickets: unknown attributes give NULL keys, the row is kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.operators import clean, dims, lookup
from starload.operators.lookup import Lookup
from starload.operators.merge import last_wins, total_order
from starload.plans.report import Report
from starload.session import materialize

# Tables a first load finds missing and creates.
CREATED = (
    "d_date", "d_project", "d_property", "dim_issue_type",
    "dim_severity", "dim_priority", "dim_status", "dim_reporter", "fact_issues",
)

# Source column -> its dimension, natural column, key column and fact column.
ATTRIBUTES = {
    "issue_type": ("dim_issue_type", "issue_type", "issue_type_key", "issue_type_key"),
    "severity": ("dim_severity", "severity", "severity_key", "severity_key"),
    "priority": ("dim_priority", "priority", "priority_key", "priority_key"),
    "status": ("dim_status", "status", "status_key", "status_key"),
    "reported_by_email": ("dim_reporter", "reported_by_email", "reporter_key", "reporter_key"),
}
SOURCE = ("issue_id", "project_id", "property_id", *ATTRIBUTES, "updated_at")


def extract(issues: DataFrame, projects: DataFrame, properties: DataFrame) -> DataFrame:
    """Issues with the names of their project and property, NULL where unknown."""
    named_properties = properties.select(
        F.col("propertyid").alias("property_id"), F.col("name").alias("property_name")
    )
    return (
        issues.select(*SOURCE)
        .join(projects.select("project_id", "project_name"), "project_id", "left")
        .join(named_properties, "property_id", "left")
        .select(
            "issue_id", "project_id", "project_name", "property_id", "property_name",
            "reported_by_email", "issue_type", "severity", "priority", "status", "updated_at",
        )
    )


def check(issues: DataFrame) -> DataFrame:
    rows = issues.select(*SOURCE).withColumn("date", F.to_date("updated_at"))
    return clean.classify(rows, [
        ("missing project_id", F.col("project_id").isNotNull()),
        ("missing property_id", F.col("property_id").isNotNull()),
        ("missing updated_at", F.col("date").isNotNull()),
        ("missing issue_id", F.col("issue_id").isNotNull()),
    ])


def _names(offered: DataFrame, dim: str, key: str, source: DataFrame, source_key: str,
           name: str, alias: str) -> DataFrame:
    """Distinct ids in use with the names the source gives them, NULL if none.

    A name depends on the id alone, so the ids are reduced before the join.
    """
    ids = offered.filter(F.col("dim") == dim).select(F.col("member").alias(key))
    side = source.select(F.col(source_key).cast("string").alias(key), F.col(name).alias(alias))
    return ids.join(side, key, "left")


def load_dimensions(
    checked: DataFrame, projects: DataFrame, properties: DataFrame, tables,
    few: dict[str, list] | None = None,
) -> None:
    """Every issue offers its attributes, also one that is rejected afterwards."""
    both = F.col("project_id").isNotNull() & F.col("property_id").isNotNull()
    values = {(dim, natural): F.col(column) for column, (dim, natural, _, _) in ATTRIBUTES.items()}
    values["d_date", "date"] = F.when(both, F.col("date"))
    named = {
        ("d_project", "project_id"): F.col("project_id"),
        ("d_property", "property_id"): F.when(both, F.col("property_id")),
    }
    # Distinct members only, needed three times.
    offered = materialize(dims.offers(checked, {**values, **named}), "issue-offers")
    dims.insert_members(
        offered.filter(~F.col("dim").isin([dim for dim, _ in named])), values, tables,
        few and {"dim_reporter": few["reported_by_email"]},
    )
    names = _names(offered, "d_project", "project_id", projects, "project_id", "project_name",
                   "project_name")
    dims.overwrite_members(names, "d_project", tables, ["project_name"], ["project_name"])
    names = _names(offered, "d_property", "property_id", properties, "propertyid", "name",
                   "property_name")
    dims.overwrite_members(names, "d_property", tables, ["property_name"], ["property_name"])


def resolve(checked: DataFrame, tables, few: dict[str, list] | None = None) -> DataFrame:
    """One row per issue with its keys; ``few`` has the reporters of a small batch."""

    def members(dim: str, natural: str) -> DataFrame:
        return tables.members(dim, natural, few["reported_by_email"] if few and dim == "dim_reporter" else None)

    rows = clean.kept(checked, "issue_id", "project_id", "property_id", "updated_at")
    found = lookup.or_null(rows, [
        Lookup("project_id", tables.read("d_project"), "project_id", "project_key", "project_key"),
        Lookup("property_id", tables.read("d_property"), "property_id", "property_key",
               "property_key"),
        *[
            Lookup(column, members(dim, natural), natural, key, output)
            for column, (dim, natural, key, output) in ATTRIBUTES.items()
        ],
        Lookup("date", tables.read("d_date"), "date", "date_key", "updated_date_key"),
    ])
    return last_wins(found, ["issue_id"], total_order(rows, ["updated_at"], ["issue_id", "date"]))


def load(issues: DataFrame, projects: DataFrame, properties: DataFrame, tables) -> Report:
    tables.create(*CREATED)
    checked = check(issues)
    few = lookup.few_values(tables, checked, "reported_by_email")
    load_dimensions(checked, projects, properties, tables, few)
    merged = tables.upsert("fact_issues", resolve(checked, tables, few))
    return Report("issues", "issue_id", checked, merged)
