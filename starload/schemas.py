"""Contracts of the target tables: columns, keys, references and declared lengths."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

TEXT, LONG, INT, DATE = T.StringType(), T.LongType(), T.IntegerType(), T.DateType()
# As Spark reads a NUMERIC of any scale; a value it would change is rejected.
AMOUNT = T.DecimalType(38, 18)


@dataclass(frozen=True)
class Table:
    """One target table.

    ``natural`` identifies a row to its source, ``surrogate`` is the key the
    warehouse gives it. ``references`` maps a column to the (table, column) it
    must be found in, ``lengths`` holds the declared text limits.
    """

    name: str
    columns: tuple[tuple[str, T.DataType], ...]
    natural: tuple[str, ...]
    surrogate: str | None = None
    references: dict[str, tuple[str, str]] = field(default_factory=dict)
    lengths: dict[str, int] = field(default_factory=dict)
    fact: bool = False
    # Columns whose hash places a fact row in its bucket; all of the natural key unless named.
    placed_by: tuple[str, ...] = ()

    @property
    def placed(self) -> tuple[str, ...]:
        return self.placed_by or self.natural

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, t, True) for n, t in self.columns])

    @property
    def names(self) -> list[str]:
        return [n for n, _ in self.columns]


def _dimension(name, key, natural, *attributes, lengths=None):
    """A dimension with a surrogate key, a text natural key and attributes."""
    columns = ((key, LONG), (natural, TEXT), *attributes)
    return Table(name, columns, (natural,), key, lengths=lengths or {})


def _fact(name, columns, natural, references, surrogate=None, lengths=None):
    return Table(name, tuple(columns), natural, surrogate, references, lengths or {}, fact=True)


_TABLES = [
    Table(
        "d_date",
        (
            ("date_key", INT), ("date", DATE), ("year", INT), ("month", INT), ("day", INT),
            ("month_name", TEXT), ("day_of_week", INT), ("week_of_year", INT), ("quarter", INT),
        ),
        ("date",),
        "date_key",
        lengths={"month_name": 20},
    ),
    Table("core_dim_date", (("date_key", INT), ("full_date", DATE)), ("full_date",), "date_key"),
    _dimension("d_project", "project_key", "project_id", ("project_name", TEXT)),
    _dimension("d_property", "property_key", "property_id", ("property_name", TEXT),
               ("budget", AMOUNT), ("usedbudget", AMOUNT)),
    _dimension("d_phase", "phase_key", "phase_name", lengths={"phase_name": 255}),
    _dimension("d_status", "status_key", "status_name", lengths={"status_name": 100}),
    _dimension("d_item", "item_key", "item_name"),
    _dimension("d_item_type", "item_type_key", "item_type"),
    _dimension("d_request_status", "status_key", "status_name"),
    _dimension("d_employees", "emp_key", "emp_id", ("first_name", TEXT), ("last_name", TEXT),
               ("email", TEXT)),
    _dimension("d_invoice", "invoice_key", "invoice_id", lengths={"invoice_id": 100}),
    _dimension("d_vendor", "vendor_key", "vendor_id", ("vendor_name", TEXT),
               lengths={"vendor_id": 20, "vendor_name": 255}),
    _dimension("dim_issue_type", "issue_type_key", "issue_type"),
    _dimension("dim_severity", "severity_key", "severity"),
    _dimension("dim_priority", "priority_key", "priority"),
    _dimension("dim_status", "status_key", "status"),
    _dimension("dim_reporter", "reporter_key", "reported_by_email"),
    _dimension("core_dim_worker", "worker_key", "worker_id", ("worker_name", TEXT),
               ("worker_type", TEXT)),
    _dimension("core_dim_status", "status_key", "status_name"),
    _dimension("core_dim_user", "user_key", "user_email"),
    Table(
        "rejects",
        (("job", TEXT), ("key", TEXT), ("reason", TEXT), ("loaded_at", T.TimestampType()),
         ("run_id", TEXT)),
        ("job", "key", "reason", "loaded_at"),
    ),
    # Counts of the runs that were given an id.
    Table(
        "run_counts",
        (("job", TEXT), ("outcome", TEXT), ("n_rows", LONG), ("loaded_at", T.TimestampType()),
         ("run_id", TEXT)),
        ("run_id", "outcome"),
    ),
    # Vendor names already matched against every stored invoice (payment stream).
    Table("vendors_seen", (("vendor_id", TEXT), ("vendor_name", TEXT)), ("vendor_id", "vendor_name")),
    # Index of the payment stream: the stretches of each supplier name, the one it is found by as
    # a pattern itself, and the files its invoices came in.
    Table("supplier_holds", (("gram", TEXT), ("name", TEXT)), ("gram", "name"), fact=True,
          placed_by=("gram",)),
    Table("supplier_leads", (("gram", TEXT), ("name", TEXT)), ("gram", "name"), fact=True,
          placed_by=("gram",)),
    Table("supplier_files", (("name", TEXT), ("file", TEXT)), ("name", "file"), fact=True,
          placed_by=("name",)),
    _fact(
        "f_inventory",
        [("inventory_id", TEXT), ("item_key", LONG), ("quantity", AMOUNT), ("project_key", LONG),
         ("date_key", INT)],
        ("inventory_id",),
        {"item_key": ("d_item", "item_key"), "project_key": ("d_project", "project_key"),
         "date_key": ("d_date", "date_key")},
    ),
    _fact(
        "fact_inventory_requests",
        [("request_key", LONG), ("request_id", TEXT), ("property_key", LONG),
         ("project_key", LONG), ("item_key", LONG), ("item_type_key", LONG),
         ("quantity", AMOUNT), ("status", LONG), ("raised_date_key", INT),
         ("updated_date_key", INT)],
        ("request_id",),
        {"property_key": ("d_property", "property_key"),
         "project_key": ("d_project", "project_key"), "item_key": ("d_item", "item_key"),
         "item_type_key": ("d_item_type", "item_type_key"),
         "status": ("d_request_status", "status_key")},
        surrogate="request_key",
    ),
    _fact(
        "f_inventory_requests",
        [("request_id", TEXT), ("item_key", LONG), ("quantity", AMOUNT), ("project_key", LONG),
         ("date_key", INT)],
        ("request_id",),
        {"item_key": ("d_item", "item_key"), "project_key": ("d_project", "project_key"),
         "date_key": ("d_date", "date_key")},
    ),
    _fact(
        "f_payments",
        [("payment_key", LONG), ("vendor_key", LONG), ("invoice_key", LONG), ("date_key", INT),
         ("total_bill_amount", TEXT), ("amount_to_pay", AMOUNT), ("paid_amount", AMOUNT),
         ("overdue_amount", AMOUNT), ("taxes_sgst", AMOUNT), ("taxes_cgst", AMOUNT),
         ("taxes_igst", TEXT), ("taxes_gst_percentage", TEXT)],
        ("vendor_key", "invoice_key", "date_key"),
        {"vendor_key": ("d_vendor", "vendor_key"), "invoice_key": ("d_invoice", "invoice_key"),
         "date_key": ("d_date", "date_key")},
        surrogate="payment_key",
        lengths={"total_bill_amount": 100, "taxes_igst": 50, "taxes_gst_percentage": 50},
    ),
    _fact(
        "f_property_schedule",
        [("scheduleid", LONG), ("property_key", LONG), ("project_key", LONG),
         ("phase_key", LONG), ("status_key", LONG), ("start_date_key", INT),
         ("end_date_key", INT), ("percentage", AMOUNT)],
        ("scheduleid",),
        {"property_key": ("d_property", "property_key"),
         "project_key": ("d_project", "project_key"), "phase_key": ("d_phase", "phase_key"),
         "status_key": ("d_status", "status_key"), "start_date_key": ("d_date", "date_key"),
         "end_date_key": ("d_date", "date_key")},
    ),
    _fact(
        "fact_issues",
        [("issue_id", TEXT), ("project_key", LONG), ("property_key", LONG),
         ("issue_type_key", LONG), ("severity_key", LONG), ("priority_key", LONG),
         ("status_key", LONG), ("reporter_key", LONG), ("updated_date_key", INT)],
        ("issue_id",),
        {"project_key": ("d_project", "project_key"),
         "property_key": ("d_property", "property_key"),
         "issue_type_key": ("dim_issue_type", "issue_type_key"),
         "severity_key": ("dim_severity", "severity_key"),
         "priority_key": ("dim_priority", "priority_key"),
         "status_key": ("dim_status", "status_key"),
         "reporter_key": ("dim_reporter", "reporter_key"),
         "updated_date_key": ("d_date", "date_key")},
    ),
    _fact(
        "fact_worker_payments",
        [("payment_id", TEXT), ("worker_key", LONG), ("work_duration_type", TEXT),
         ("total_hours_worked", AMOUNT), ("total_sqft_completed", AMOUNT),
         ("total_days", AMOUNT), ("gross_amount", AMOUNT), ("tds_percent", AMOUNT),
         ("tds_amount", AMOUNT), ("net_amount", AMOUNT), ("payment_mode", TEXT),
         ("status_key", LONG), ("created_by_key", LONG), ("created_date_key", INT)],
        ("payment_id",),
        {"worker_key": ("core_dim_worker", "worker_key"),
         "status_key": ("core_dim_status", "status_key"),
         "created_by_key": ("core_dim_user", "user_key"),
         "created_date_key": ("core_dim_date", "date_key")},
    ),
]

TABLES: dict[str, Table] = {t.name: t for t in _TABLES}


def conform(df, table: str):
    """``df`` with the columns and types of the contract; absent columns are NULL."""
    from pyspark.sql import functions as F

    have = set(df.columns)
    return df.select(
        *[
            (F.col(name) if name in have else F.lit(None)).cast(dtype).alias(name)
            for name, dtype in TABLES[table].columns
        ]
    )


def empty(spark, table: str):
    """The table without rows, in a form the optimizer recognizes as empty."""
    return conform(spark.range(0).limit(0).drop("id"), table)
