"""Small fixtures in, sorted plain rows out."""

from datetime import date, datetime
from decimal import Decimal

from starload.schemas import TABLES
from starload.sources.tables import SessionTables


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    return value


def rows(df, *columns):
    """Rows as tuples, in an order that does not depend on the plan."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(plain(v) for v in r) for r in picked.collect()), key=repr)


def day(text):
    return date.fromisoformat(text)


def at(text):
    return datetime.fromisoformat(text)


INVENTORY = "inventory_id string, item_name string, quantity decimal(18,2), location string, " \
            "updated_date timestamp_ntz"
EMPLOYEES = "employee_code string, first_name string, last_name string, email string"
REQUESTS = "request_id string, property_name string, project_name string, item_name string, " \
           "item_type string, requested_quantity decimal(18,2), status string, " \
           "created_at timestamp_ntz, updated_at timestamp_ntz"
INVOICES = "avenue_created_invoice_id string, supplier_name string, created_date timestamp_ntz, " \
           "total_bill_amount string, amount_to_pay decimal(18,2), paid_amount decimal(18,2), " \
           "overdue_amount decimal(18,2), taxes_sgst decimal(18,2), taxes_cgst decimal(18,2), " \
           "taxes_igst string, taxes_gst_percentage string"
VENDORS = "vendor_id string, vendor_name string"
PROPERTY_SCHEDULE = "propertyscheduleid long, propertyid string, is_deleted boolean"
SCHEDULE = "scheduleid long, propertyscheduleid long, phasename string, startdate date, " \
           "enddate date, status string, percentage decimal(18,2)"
PROPERTIES = "propertyid string, projectid string, name string, budget decimal(18,2), " \
             "usedbudget decimal(18,2)"
PROJECTS = "project_id string, project_name string"
ISSUES = "issue_id string, project_id string, property_id string, reported_by_email string, " \
         "issue_type string, severity string, priority string, status string, " \
         "updated_at timestamp_ntz"
PAYMENTS = "payment_id string, worker_id string, worker_name string, worker_type string, " \
           "work_duration_type string, total_hours_worked decimal(18,2), " \
           "total_sqft_completed decimal(18,2), total_days decimal(18,2), " \
           "gross_amount decimal(18,2), tds_percent decimal(18,2), tds_amount decimal(18,2), " \
           "net_amount decimal(18,2), payment_mode string, status string, created_by string, " \
           "created_at timestamp_ntz"


def frame(spark, schema, *records):
    return spark.createDataFrame(list(records), schema)


def invoice(number, supplier, when, amount, bill="b"):
    money = Decimal(amount)
    return (number, supplier, at(when), bill, money, money, None, None, None, "i", "g")


def worker_payment(number, worker, name, status, user, when, gross="10"):
    return (number, worker, name, "mason", "hourly", None, None, None, Decimal(gross), None, None,
            None, "cash", status, user, at(when) if when else None)


def members(tables, name):
    """Natural key and attributes of a dimension, without the surrogate key."""
    contract = TABLES[name]
    return rows(tables.read(name), *[c for c in contract.names if c != contract.surrogate])


def named_fact(tables, fact, **joins):
    """Fact rows with the natural names behind their keys.

    ``joins`` maps a key column to (dimension, key, shown column).
    """
    df = tables.read(fact)
    for column, (dim, key, shown) in joins.items():
        side = tables.read(dim).select(key, shown).toDF("_k", f"{column}_name")
        df = df.join(side, df[column] == side["_k"], "left").drop("_k", column)
    return df


def session_tables(spark, **frames):
    return SessionTables(spark, frames)
