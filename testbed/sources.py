"""Each load's source tables, derived from the test tables.

The texts run both on Spark and on DuckDB. Some fields are blanked by line number
or status, so that every rule of the loads meets rows that break it.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
# Rows before this day make up the stored tables, later ones or all rows the batch.
SPLIT = "TIMESTAMP '1999-01-01 00:00:00'"
ISSUE_SPLIT = "TIMESTAMP '2024-01-16 00:00:00'"

SOURCES = {
    "inventory": """
        SELECT CAST(l_orderkey * 10 + l_linenumber AS STRING) AS inventory_id,
               CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN NULL ELSE p_name END
                 AS item_name,
               CAST(l_quantity AS DECIMAL(38,6)) AS quantity,
               CASE WHEN l_returnflag = 'A' AND l_linenumber = 6 THEN NULL ELSE n_name END
                 AS location,
               CASE WHEN l_returnflag = 'N' AND l_linenumber = 5 THEN NULL ELSE l_shipdate END
                 AS updated_date
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
        JOIN {supplier} ON l_suppkey = s_suppkey JOIN {nation} ON s_nationkey = n_nationkey""",
    "blank_inventory": """
        SELECT CAST(l_orderkey * 10 + l_linenumber AS STRING) AS inventory_id,
               CASE WHEN l_linenumber = 7 THEN '' WHEN l_linenumber = 6 THEN '  '
                    ELSE p_name END AS item_name,
               CAST(l_quantity AS DECIMAL(38,6)) AS quantity,
               CASE WHEN l_linenumber = 6 THEN NULL ELSE p_brand END AS location,
               l_shipdate AS updated_date
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey""",
    # Quantities as text: finer than six places, finer than any column, and whole ones.
    "fine_inventory": """
        SELECT CAST(l_orderkey * 10 + l_linenumber AS STRING) AS inventory_id,
               l_returnflag AS item_name,
               CASE WHEN l_linenumber = 1 THEN '0.000000400'
                    WHEN l_linenumber = 2 THEN '0.0000000000000000001'
                    WHEN l_linenumber = 3 THEN '4e-7'
                    ELSE CAST(l_linenumber AS STRING) || '.50' END AS quantity,
               l_linestatus AS location, l_shipdate AS updated_date
        FROM {lineitem}""",
    "members": """
        SELECT CAST(c_nationkey AS BIGINT) AS vendor_key,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN c_name || '-' || c_mktsegment
                    ELSE c_name END AS vendor_id,
               c_mktsegment AS vendor_name
        FROM {customer}""",
    "employees": """
        SELECT CASE WHEN c_acctbal < 0 THEN NULL
                    ELSE CAST(c_nationkey AS STRING) || '-' || c_mktsegment END AS employee_code,
               c_name AS first_name, c_mktsegment AS last_name,
               lower(c_name) || '@example.com' AS email
        FROM {customer}""",
    "inventory_requests": """
        SELECT CAST(l_orderkey * 10 + l_linenumber AS STRING) AS request_id,
               s_name AS property_name, n_name AS project_name, p_name AS item_name,
               CASE WHEN l_linenumber = 6 THEN NULL ELSE p_type END AS item_type,
               CASE WHEN l_linenumber = 2 THEN NULL ELSE CAST(l_quantity AS DECIMAL(38,6)) END
                 AS requested_quantity,
               CASE WHEN l_linenumber = 7 THEN '' WHEN l_linenumber = 5 THEN '  '
                    ELSE l_linestatus END AS status,
               o_orderdate AS created_at,
               CASE WHEN l_linenumber = 4 AND l_returnflag = 'A' THEN NULL ELSE l_shipdate END
                 AS updated_at
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
        JOIN {part} ON l_partkey = p_partkey
        JOIN {supplier} ON l_suppkey = s_suppkey JOIN {nation} ON s_nationkey = n_nationkey""",
    "known_items": "SELECT DISTINCT p_name AS item_name FROM {part} WHERE p_name NOT LIKE 'blue%'",
    "known_projects": """
        SELECT CAST(n_nationkey AS STRING) AS project_id, n_name AS project_name
        FROM {nation} WHERE n_regionkey <> 0""",
    "known_properties": """
        SELECT CAST(s_suppkey AS STRING) AS property_id, s_name AS property_name
        FROM {supplier} WHERE s_acctbal > 0""",
    "invoice_master": """
        SELECT CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL
                    ELSE 'INV-' || CAST(o_custkey AS STRING) END AS avenue_created_invoice_id,
               CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '4-NOT SPECIFIED' THEN NULL
                    ELSE n_name END AS supplier_name,
               date_trunc('month', o_orderdate) AS created_date,
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS total_bill_amount,
               CAST(o_totalprice AS DECIMAL(38,6)) AS amount_to_pay,
               CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(38,6))
                    ELSE CAST(0 AS DECIMAL(38,6)) END AS paid_amount,
               CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(38,6)) END
                 AS overdue_amount,
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST('0.09' AS DECIMAL(3,2))
                    AS DECIMAL(38,6)) AS taxes_sgst,
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST('0.09' AS DECIMAL(3,2))
                    AS DECIMAL(38,6)) AS taxes_cgst,
               o_orderpriority AS taxes_igst, '18' AS taxes_gst_percentage
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey
        JOIN {nation} ON c_nationkey = n_nationkey""",
    "vendor": "SELECT CAST(n_nationkey AS STRING) AS vendor_id, n_name AS vendor_name FROM {nation}",
    "property_schedule": """
        SELECT o_orderkey AS propertyscheduleid, CAST(o_custkey AS STRING) AS propertyid,
               CASE WHEN o_orderstatus = 'F' THEN TRUE
                    WHEN o_orderpriority = '5-LOW' THEN NULL ELSE FALSE END AS is_deleted
        FROM {orders}""",
    "schedule": """
        SELECT l_orderkey * 10 + l_linenumber AS scheduleid, l_orderkey AS propertyscheduleid,
               CASE WHEN l_linenumber = 5 AND l_returnflag = 'R' THEN NULL ELSE l_returnflag END
                 AS phasename,
               CASE WHEN l_linenumber = 4 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS startdate,
               CASE WHEN l_linenumber = 3 THEN NULL
                    ELSE CAST(l_shipdate AS DATE) + l_linenumber * 10 END AS enddate,
               l_linestatus AS status, CAST(l_discount AS DECIMAL(38,6)) AS percentage
        FROM {lineitem}""",
    "properties": """
        SELECT CAST(c_custkey AS STRING) AS propertyid, CAST(c_nationkey AS STRING) AS projectid,
               c_name AS name, CAST(c_acctbal AS DECIMAL(38,6)) AS budget,
               CASE WHEN c_acctbal < 0 THEN NULL
                    ELSE CAST(CAST(c_acctbal AS DECIMAL(18,2)) * CAST('0.50' AS DECIMAL(3,2))
                              AS DECIMAL(38,6)) END AS usedbudget
        FROM {customer}""",
    "old_properties": """
        SELECT CAST(c_custkey AS STRING) AS propertyid, CAST(c_nationkey AS STRING) AS projectid,
               c_mktsegment AS name, CAST(NULL AS DECIMAL(38,6)) AS budget,
               CAST(1 AS DECIMAL(38,6)) AS usedbudget
        FROM {customer}""",
    "projects": """
        SELECT CAST(n_nationkey AS STRING) AS project_id, n_name AS project_name FROM {nation}""",
    "old_projects": """
        SELECT CAST(n_nationkey AS STRING) AS project_id, r_name AS project_name
        FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "issue_projects": """
        SELECT CAST(n_nationkey AS STRING) AS project_id, n_name AS project_name
        FROM {nation} WHERE n_regionkey <> 1""",
    "issue_master": """
        SELECT 'T' || CAST(user_id AS STRING) || '-' || event_type AS issue_id,
               CASE WHEN event_type = 'error' AND value < 5 THEN NULL
                    ELSE CAST(user_id % 30 AS STRING) END AS project_id,
               CASE WHEN event_type = 'click' AND value < 5 THEN NULL
                    ELSE CAST(user_id AS STRING) END AS property_id,
               'user' || CAST(user_id AS STRING) || '@example.com' AS reported_by_email,
               event_type AS issue_type,
               CASE WHEN value >= 100 THEN 'high' WHEN value >= 20 THEN 'medium'
                    WHEN value >= 5 THEN 'low' END AS severity,
               CASE WHEN value >= 50 THEN 'P1' ELSE 'P2' END AS priority,
               CASE WHEN event_type = 'purchase' THEN 'closed' WHEN event_type = 'signup' THEN NULL
                    ELSE 'open' END AS status,
               CASE WHEN event_type = 'view' AND value < 5 THEN NULL ELSE ts END AS updated_at
        FROM {events}""",
    "worker_payments": """
        SELECT CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN NULL
                    ELSE CAST(o_orderkey AS STRING) END AS payment_id,
               CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED' THEN NULL
                    ELSE CAST(c_custkey AS STRING) END AS worker_id,
               c_name || '/' || o_orderpriority AS worker_name, c_mktsegment AS worker_type,
               CASE WHEN o_orderstatus = 'F' THEN 'hourly' ELSE 'sqft' END AS work_duration_type,
               CAST(o_orderkey % 12 AS DECIMAL(38,6)) AS total_hours_worked,
               CASE WHEN o_orderstatus = 'F' THEN NULL
                    ELSE CAST(o_totalprice AS DECIMAL(38,6)) END AS total_sqft_completed,
               CAST(o_custkey % 31 AS DECIMAL(38,6)) AS total_days,
               CAST(o_totalprice AS DECIMAL(38,6)) AS gross_amount,
               CAST(10 AS DECIMAL(38,6)) AS tds_percent,
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST('0.10' AS DECIMAL(3,2))
                    AS DECIMAL(38,6)) AS tds_amount,
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST('0.90' AS DECIMAL(3,2))
                    AS DECIMAL(38,6)) AS net_amount,
               CASE WHEN o_orderstatus = 'O' THEN 'cash' ELSE 'bank' END AS payment_mode,
               o_orderstatus AS status,
               CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' THEN NULL
                    ELSE o_orderpriority END AS created_by,
               o_orderdate AS created_at
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    # Payment ids that come for several orders, a day or more apart or the same day.
    "repeated_payments": """
        SELECT 'P' || CAST(o_custkey AS STRING) AS payment_id,
               CAST(o_custkey % 97 AS STRING) AS worker_id,
               'W' || CAST(o_custkey % 97 AS STRING) AS worker_name, c_mktsegment AS worker_type,
               o_orderpriority AS work_duration_type,
               CAST(o_orderkey AS DECIMAL(38,6)) AS total_hours_worked,
               CAST(NULL AS DECIMAL(38,6)) AS total_sqft_completed,
               CAST(NULL AS DECIMAL(38,6)) AS total_days,
               CAST(o_totalprice AS DECIMAL(38,6)) AS gross_amount,
               CAST(10 AS DECIMAL(38,6)) AS tds_percent, CAST(NULL AS DECIMAL(38,6)) AS tds_amount,
               CAST(NULL AS DECIMAL(38,6)) AS net_amount, 'cash' AS payment_mode,
               o_orderstatus AS status, o_orderpriority AS created_by, o_orderdate AS created_at
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    "bad_requests": """
        SELECT CAST(l_orderkey * 10 + l_linenumber AS STRING) AS request_id,
               s_name AS property_name, n_name AS project_name, p_name AS item_name,
               CASE WHEN l_linenumber = 6 THEN '  ' WHEN l_linenumber = 5 THEN chr(9)
                    ELSE p_type END AS item_type,
               CASE WHEN l_linenumber = 2 THEN 'many' WHEN l_linenumber = 3 THEN '0'
                    WHEN l_linenumber = 4 THEN NULL ELSE '1.5' END AS requested_quantity,
               CASE WHEN l_linenumber = 7 THEN ' ' ELSE l_linestatus END AS status,
               o_orderdate AS created_at, l_shipdate AS updated_at
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
        JOIN {part} ON l_partkey = p_partkey
        JOIN {supplier} ON l_suppkey = s_suppkey JOIN {nation} ON s_nationkey = n_nationkey""",
    "core_dim_date": """
        SELECT CAST(CAST(day AS DATE) AS DATE) AS full_date,
               year(day) * 10000 + month(day) * 100 + day(day) AS date_key
        FROM (SELECT DISTINCT o_orderdate AS day FROM {orders}) AS days""",
    "shipping_dates": """
        SELECT CAST(day AS DATE) AS full_date,
               year(day) * 10000 + month(day) * 100 + day(day) AS date_key
        FROM (SELECT DISTINCT l_shipdate AS day FROM {lineitem}
              WHERE l_returnflag = 'R') AS days""",
    # Records before they are put into payloads: two per order, the second one revised.
    "payload_records": """
        SELECT o_orderdate AS arrived_at, CAST(o_orderkey AS STRING) AS payload_id, 0 AS position,
               'R' || CAST(o_custkey AS STRING) AS request_id, o_orderpriority AS item_name,
               CASE WHEN o_orderkey % 11 = 0 THEN CAST(0 AS DECIMAL(18,2))
                    ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS number_quantity,
               CAST(NULL AS STRING) AS text_quantity, n_name AS location,
               CASE WHEN o_orderkey % 7 = 0
                    THEN CAST(year(o_orderdate) AS STRING) || '-13-01'
                    ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS requested_date
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey
        JOIN {nation} ON c_nationkey = n_nationkey
        UNION ALL
        SELECT o_orderdate, CAST(o_orderkey AS STRING), 1, 'R' || CAST(o_custkey AS STRING),
               CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE c_mktsegment END,
               CAST(NULL AS DECIMAL(18,2)),
               CASE WHEN o_orderkey % 11 = 1 THEN '0' WHEN o_orderkey % 11 = 2 THEN 'many'
                    ELSE CAST(o_orderkey AS STRING) END,
               n_name,
               CAST(year(o_orderdate) AS STRING) || '-' || CAST(month(o_orderdate) AS STRING)
                 || '-' || CASE WHEN o_orderkey % 7 = 3 THEN '007'
                                ELSE CAST(day(o_orderdate) AS STRING) END
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey
        JOIN {nation} ON c_nationkey = n_nationkey""",
    "customer_names": """
        SELECT c_name || ' ' || c_mktsegment AS name FROM {customer}""",
    "name_patterns": """
        SELECT c_name AS name FROM {customer}
        UNION ALL SELECT replace(c_name, '0', '_') FROM {customer} WHERE c_nationkey = 7
        UNION ALL SELECT substr(c_name, 1, 8) || '%' || c_mktsegment FROM {customer}
        WHERE c_nationkey = 3""",
    "customer_invoices": """
        SELECT CAST(o_orderkey AS STRING) AS avenue_created_invoice_id,
               upper(c_name) || ' ' || c_mktsegment AS supplier_name, o_orderdate AS created_date,
               '1' AS total_bill_amount, CAST(o_totalprice AS DECIMAL(38,6)) AS amount_to_pay,
               CAST(NULL AS DECIMAL(38,6)) AS paid_amount, CAST(NULL AS DECIMAL(38,6)) AS overdue_amount,
               CAST(NULL AS DECIMAL(38,6)) AS taxes_sgst, CAST(NULL AS DECIMAL(38,6)) AS taxes_cgst,
               '2' AS taxes_igst, '3' AS taxes_gst_percentage
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    "customer_vendors": """
        SELECT CAST(c_custkey AS STRING) AS vendor_id, c_name AS vendor_name FROM {customer}""",
}


def tables(sql: str) -> list[str]:
    return [t for t in TEST_TABLES if "{" + t + "}" in sql]


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A source table as a DataFrame over the test tables."""
    text = SOURCES[name]
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables(text)}
    return spark.sql(text, **frames)


@functools.cache
def source_sql(name: str) -> str:
    """The same source as a query for DuckDB."""
    return SOURCES[name].format(**{t: t for t in TEST_TABLES})
