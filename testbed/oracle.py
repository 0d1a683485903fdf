"""The expected result of each query as plain SQL for DuckDB."""

from __future__ import annotations

from testbed.sources import ISSUE_SPLIT, SPLIT, source_sql

ORACLE: dict[str, str] = {}


def with_(ctes: list[tuple[str, str]], body: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in ctes) + "\n" + body


def src(name: str, alias: str = "src") -> tuple[str, str]:
    return alias, source_sql(name)


def members(name: str, first: str, second: str | None = None) -> list[tuple[str, str]]:
    """Member m and key k after one or two loads offering the members m."""
    numbered = "SELECT m, row_number() OVER (ORDER BY m) AS k FROM (SELECT DISTINCT m FROM ({}))"
    ctes = [(f"{name}_1", numbered.format(f"SELECT m FROM ({first}) WHERE m IS NOT NULL"))]
    if second is None:
        return [*ctes, (name, f"SELECT * FROM {name}_1")]
    fresh = f"""SELECT m FROM ({second}) WHERE m IS NOT NULL
                AND m NOT IN (SELECT m FROM {name}_1)"""
    top = f"(SELECT coalesce(max(k), 0) FROM {name}_1)"
    return [
        *ctes,
        (f"{name}_2", f"SELECT m, k + {top} AS k FROM ({numbered.format(fresh)})"),
        (name, f"SELECT * FROM {name}_1 UNION ALL SELECT * FROM {name}_2"),
    ]


def dkey(column: str) -> str:
    return f"CAST(strftime({column}, '%Y%m%d') AS INTEGER)"


def day(column: str) -> str:
    return f"CAST(CAST({column} AS DATE) AS VARCHAR)"


def ts(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def dbl(column: str) -> str:
    return f"CAST({column} AS DOUBLE)"


def best(rows: str, key: str, order: list[str], how: str) -> str:
    """One row per key, the first ("ASC NULLS LAST") or last ("DESC NULLS FIRST")."""
    by = ", ".join(f"{c} {how}" for c in order)
    return f"""SELECT * FROM {rows}
               QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {by}) = 1"""


FIRST, LAST = "ASC NULLS LAST", "DESC NULLS FIRST"
EARLY = f"coalesce({{}} < {SPLIT}, FALSE)"

# Stock

INVENTORY = [
    src("inventory"),
    ("a", f"SELECT *, 1 AS run FROM src WHERE {EARLY.format('updated_date')}"),
    ("b", f"SELECT *, 2 AS run FROM src WHERE NOT {EARLY.format('updated_date')}"),
    *members("item", *[f"SELECT item_name AS m FROM {x} WHERE updated_date IS NOT NULL"
                       for x in "ab"]),
    *members("proj", *[f"""SELECT location AS m FROM {x}
                           WHERE updated_date IS NOT NULL AND item_name IS NOT NULL"""
                       for x in "ab"]),
    ("rows_kept", """SELECT * FROM (SELECT * FROM a UNION ALL SELECT * FROM b)
        WHERE updated_date IS NOT NULL AND item_name IS NOT NULL AND location IS NOT NULL"""),
    ("won", best("rows_kept", "inventory_id",
                 ["run", "updated_date", "item_name", "quantity", "location"], LAST)),
    ("fact", f"""SELECT inventory_id, item.k AS item_key, {dbl('quantity')} AS quantity,
                        proj.k AS project_key, {dkey('updated_date')} AS date_key
                 FROM won JOIN item ON item.m = item_name JOIN proj ON proj.m = location"""),
]
ORACLE["upsert_inventory"] = with_(INVENTORY, "SELECT * FROM fact")
ORACLE["scan_inventory"] = with_([src("inventory")], f"""
    SELECT inventory_id, item_name, {dbl('quantity')} AS quantity, location,
           {ts('updated_date')} AS updated_date FROM src""")
ORACLE["last_wins_batch"] = with_(
    [src("inventory"), ("x", "SELECT * FROM src WHERE updated_date IS NOT NULL")],
    f"""SELECT inventory_id, item_name, {dbl('quantity')} AS quantity, location,
               {ts('updated_date')} AS updated_date
        FROM ({best('x', 'inventory_id', ['updated_date', 'item_name', 'quantity', 'location'],
                    LAST)})""")
ORACLE["check_unique"] = with_([src("inventory")], """
    SELECT inventory_id, count(*) AS n_rows FROM src GROUP BY inventory_id HAVING count(*) > 1""")
ORACLE["check_foreign_keys"] = with_([*INVENTORY, src("core_dim_date", "days")], """
    SELECT date_key AS value, count(*) AS n_rows FROM fact
    WHERE date_key NOT IN (SELECT date_key FROM days) GROUP BY date_key""")
ORACLE["empty_target_bootstrap"] = with_(
    [src("inventory"), ("dated", "SELECT * FROM src WHERE updated_date IS NOT NULL")], """
    SELECT 'd_date' AS table_name, CAST(0 AS BIGINT) AS rows_before,
           count(DISTINCT CAST(updated_date AS DATE)) AS rows_after FROM dated
    UNION ALL SELECT 'd_item', 0, count(DISTINCT item_name) FROM dated
    UNION ALL SELECT 'd_project', 0, count(DISTINCT location) FROM dated
    WHERE item_name IS NOT NULL
    UNION ALL SELECT 'f_inventory', 0, count(DISTINCT inventory_id) FROM dated
    WHERE item_name IS NOT NULL AND location IS NOT NULL""")
ORACLE["purge_blank_members"] = with_(
    [src("blank_inventory"), *members("item", "SELECT item_name AS m FROM src"),
     ("won", best("(SELECT * FROM src WHERE location IS NOT NULL)", "inventory_id",
                  ["updated_date", "item_name", "quantity", "location"], LAST))], """
    SELECT k AS item_key, m AS item_name,
           CASE WHEN trim(m) <> '' THEN 'kept'
                WHEN m IN (SELECT item_name FROM won) THEN 'held' ELSE 'purged' END AS outcome
    FROM item""")

# Requests


def nonblank_members(name: str, column: str, *rows: str) -> list[tuple[str, str]]:
    return members(name, *[f"SELECT {column} AS m FROM {r} WHERE trim({column}) <> ''"
                           for r in rows])


def known(name: str, source: str, identity: str, label: str) -> tuple[str, str]:
    return name, f"""SELECT {label} AS m, row_number() OVER (ORDER BY {identity}) AS k
                     FROM ({source_sql(source)})"""


def request_ctes(*loads: str) -> list[tuple[str, str]]:
    return [
        src("inventory_requests"),
        ("early", f"SELECT * FROM src WHERE {EARLY.format('updated_at')}"),
        known("item", "known_items", "item_name", "item_name"),
        known("proj", "known_projects", "project_id", "project_name"),
        known("prop", "known_properties", "property_id", "property_name"),
        *nonblank_members("itype", "item_type", *loads),
        *nonblank_members("rstat", "status", *loads),
        ("resolved", f"""
            SELECT src.*, requested_quantity AS quantity, rstat.k AS request_status_key,
                   itype.k AS item_type_key, proj.k AS project_key, prop.k AS property_key,
                   item.k AS item_key, {dkey('created_at')} AS raised_date_key,
                   {dkey('updated_at')} AS updated_date_key,
                   CASE WHEN coalesce(request_id, '') = '' OR coalesce(property_name, '') = ''
                          OR coalesce(project_name, '') = '' OR coalesce(item_name, '') = ''
                          OR coalesce(item_type, '') = '' OR coalesce(status, '') = ''
                        THEN 'incomplete'
                        WHEN rstat.k IS NULL THEN 'unknown status'
                        WHEN itype.k IS NULL THEN 'unknown item_type'
                        WHEN proj.k IS NULL THEN 'unknown project_name'
                        WHEN prop.k IS NULL THEN 'unknown property_name'
                        WHEN item.k IS NULL THEN 'unknown item_name' END AS reject_reason
            FROM src LEFT JOIN rstat ON rstat.m = status LEFT JOIN itype ON itype.m = item_type
            LEFT JOIN proj ON proj.m = project_name LEFT JOIN prop ON prop.m = property_name
            LEFT JOIN item ON item.m = item_name"""),
    ]


ONE_LOAD, TWO_LOADS = request_ctes("src"), request_ctes("early", "src")
REQUEST_ORDER = ["updated_at", "property_name", "project_name", "item_name", "item_type",
                 "requested_quantity", "status", "created_at"]
ORACLE["project_requests"] = with_([src("inventory_requests")], f"""
    SELECT request_id, property_name, project_name, item_name, item_type,
           {dbl('requested_quantity')} AS quantity, status FROM src""")
ORACLE["first_wins_batch"] = with_([src("inventory_requests")], f"""
    SELECT request_id, property_name, project_name, item_name, item_type,
           {dbl('requested_quantity')} AS quantity, status, {ts('created_at')} AS created_at,
           {ts('updated_at')} AS updated_at
    FROM ({best('src', 'request_id', REQUEST_ORDER, FIRST)})""")
ORACLE["filter_nonblank"] = with_([src("inventory_requests")], """
    SELECT request_id, item_type, status FROM src
    WHERE item_type IS NOT NULL AND trim(item_type) != ''
      AND status IS NOT NULL AND trim(status) != ''""")
ORACLE["complete_requests"] = with_([src("inventory_requests")], f"""
    SELECT request_id, item_type, status, {dkey('created_at')} AS raised_date_key,
           {dkey('updated_at')} AS updated_date_key,
           CASE WHEN item_type IS NULL OR status = '' THEN 'incomplete' END AS reject_reason
    FROM src""")
ORACLE["distinct_item_types"] = with_([src("inventory_requests")], """
    SELECT DISTINCT item_type FROM src WHERE item_type IS NOT NULL AND trim(item_type) != ''""")
ORACLE["distinct_employees"] = with_([src("employees")], """
    SELECT DISTINCT employee_code AS emp_id, first_name, last_name, email FROM src""")
ORACLE["dim_item_type"] = with_(ONE_LOAD, "SELECT k AS item_type_key, m AS item_type FROM itype")
ORACLE["dim_request_status"] = with_(
    ONE_LOAD, "SELECT k AS status_key, m AS status_name FROM rstat")
ORACLE["dim_employees"] = with_(
    [("src", f"SELECT * FROM ({source_sql('employees')}) WHERE employee_code IS NOT NULL"),
     ("won", best("src", "employee_code", ["first_name", "last_name", "email"], FIRST))], """
    SELECT row_number() OVER (ORDER BY employee_code) AS emp_key, employee_code AS emp_id,
           first_name, last_name, email FROM won""")
ORACLE["resolve_requests"] = with_(ONE_LOAD, f"""
    SELECT request_id, request_status_key, item_type_key, project_key, property_key, item_key,
           {dbl('quantity')} AS quantity, raised_date_key, updated_date_key
    FROM resolved WHERE reject_reason IS NULL""")
ORACLE["rejected_requests"] = with_(ONE_LOAD, """
    SELECT 'requests' AS job, request_id AS key, reject_reason AS reason
    FROM resolved WHERE reject_reason IS NOT NULL""")
ORACLE["load_counters"] = with_(ONE_LOAD, """
    SELECT coalesce(reject_reason, 'loaded') AS outcome, count(*) AS n_rows
    FROM resolved GROUP BY 1""")
ORACLE["insert_new_requests"] = with_(
    [*TWO_LOADS, ("won", best("(SELECT * FROM resolved WHERE reject_reason IS NULL)",
                              "request_id", REQUEST_ORDER, FIRST))], f"""
    SELECT request_id, property_key, project_key, item_key, item_type_key,
           {dbl('quantity')} AS quantity, request_status_key AS status, raised_date_key,
           updated_date_key
    FROM won""")

# Payments

MATCHED = ("matched", """
    SELECT bi.avenue_created_invoice_id AS invoice_id, v.vendor_id, v.vendor_name, bi.*
    FROM bi JOIN v ON lower(bi.supplier_name) ILIKE '%' || lower(v.vendor_name) || '%'
                   OR lower(v.vendor_name) ILIKE '%' || lower(bi.supplier_name) || '%'
    WHERE bi.avenue_created_invoice_id IS NOT NULL AND bi.created_date IS NOT NULL
      AND bi.supplier_name IS NOT NULL""")
PAYMENTS = [
    src("invoice_master", "bi"), src("vendor", "v"), MATCHED,
    ("early", f"SELECT * FROM matched WHERE {EARLY.format('created_date')}"),
    *members("inv", "SELECT invoice_id AS m FROM early", "SELECT invoice_id AS m FROM matched"),
    *members("ven", "SELECT vendor_id AS m FROM early", "SELECT vendor_id AS m FROM matched"),
    ("won", best("matched", "vendor_id, invoice_id, CAST(created_date AS DATE)",
                 ["created_date", "vendor_name", "total_bill_amount", "amount_to_pay",
                  "paid_amount", "overdue_amount", "taxes_sgst", "taxes_cgst", "taxes_igst",
                  "taxes_gst_percentage"], FIRST)),
]
ORACLE["filter_not_null"] = with_([src("invoice_master")], f"""
    SELECT avenue_created_invoice_id, supplier_name, {ts('created_date')} AS created_date,
           total_bill_amount
    FROM src WHERE avenue_created_invoice_id IS NOT NULL AND created_date IS NOT NULL
      AND supplier_name IS NOT NULL""")
ORACLE["fuzzy_vendor_match"] = with_(
    [src("invoice_master", "bi"), src("vendor", "v"), MATCHED], f"""
    SELECT invoice_id, vendor_id, vendor_name, {ts('created_date')} AS created_date,
           total_bill_amount FROM matched""")
ORACLE["dim_invoice"] = with_(PAYMENTS, "SELECT k AS invoice_key, m AS invoice_id FROM inv")
ORACLE["dim_vendor_first_seen"] = with_(PAYMENTS, f"""
    SELECT ven.k AS vendor_key, vendor_id, vendor_name
    FROM ({best('matched', 'vendor_id', ['created_date', 'invoice_id', 'vendor_name'], FIRST)}) x
    JOIN ven ON ven.m = vendor_id""")
ORACLE["insert_absent_payments"] = with_(PAYMENTS, f"""
    SELECT ven.k AS vendor_key, inv.k AS invoice_key, {dkey('created_date')} AS date_key,
           total_bill_amount,
           {', '.join(f'{dbl(c)} AS {c}' for c in ('amount_to_pay', 'paid_amount',
                                                   'overdue_amount', 'taxes_sgst',
                                                   'taxes_cgst'))},
           taxes_igst, taxes_gst_percentage
    FROM won JOIN ven ON ven.m = vendor_id JOIN inv ON inv.m = invoice_id""")
ORACLE["fuzzy_casefold"] = """
    WITH a AS (SELECT DISTINCT lower(p_name) AS n FROM part WHERE p_name IS NOT NULL),
         b AS (SELECT DISTINCT lower(p_type) AS n FROM part WHERE p_type IS NOT NULL)
    SELECT a.n AS "left", b.n AS "right" FROM a JOIN b
      ON a.n ILIKE '%' || b.n || '%' OR b.n ILIKE '%' || a.n || '%'"""
ORACLE["fuzzy_blocked"] = f"""
    WITH a AS (SELECT DISTINCT lower(name) AS n FROM ({source_sql('customer_names')})),
         b AS (SELECT DISTINCT lower(name) AS n FROM ({source_sql('name_patterns')}))
    SELECT a.n AS "left", b.n AS "right" FROM a JOIN b
      ON a.n ILIKE '%' || b.n || '%' OR b.n ILIKE '%' || a.n || '%'"""
ORACLE["match_many_vendors"] = with_([src("customer_invoices", "bi"), src("customer_vendors", "v"), (
    "pairs", """SELECT s.supplier_name, v.vendor_id, v.vendor_name
                FROM (SELECT DISTINCT supplier_name FROM bi) s
                JOIN v ON contains(lower(s.supplier_name), lower(v.vendor_name))
                       OR contains(lower(v.vendor_name), lower(s.supplier_name))""")], f"""
    SELECT avenue_created_invoice_id AS invoice_id, vendor_id, vendor_name,
           {dbl('amount_to_pay')} AS amount_to_pay
    FROM bi JOIN pairs USING (supplier_name)""")

# Schedules


def four_way(name: str, schedule: str, properties: str, projects: str) -> tuple[str, str]:
    return name, f"""
        SELECT ps.propertyid AS property_id, mp.project_id, mp.project_name,
               p.name AS property_name, p.budget, p.usedbudget, s.scheduleid, s.phasename,
               s.startdate, s.enddate, s.status, s.percentage
        FROM ps JOIN ({schedule}) s ON ps.propertyscheduleid = s.propertyscheduleid
        JOIN ({source_sql(properties)}) p ON ps.propertyid = p.propertyid
        JOIN ({source_sql(projects)}) mp ON p.projectid = mp.project_id
        WHERE ps.is_deleted = FALSE"""


SCHEDULE = [
    src("property_schedule", "ps"),
    four_way("x1", f"SELECT * FROM ({source_sql('schedule')}) WHERE startdate < {SPLIT}",
             "old_properties", "old_projects"),
    four_way("x2", source_sql("schedule"), "properties", "projects"),
    *members("proj", *[f"SELECT project_id AS m FROM {x}" for x in ("x1", "x2")]),
    *members("prop", *[f"SELECT property_id AS m FROM {x}" for x in ("x1", "x2")]),
    *members("phase", *[f"SELECT phasename AS m FROM {x}" for x in ("x1", "x2")]),
    *members("stat", *[f"SELECT status AS m FROM {x} WHERE phasename IS NOT NULL"
                       for x in ("x1", "x2")]),
]
SCHEDULE_ORDER = ["property_id", "startdate", "project_name", "property_name", "budget",
                  "usedbudget", "project_id", "phasename", "enddate", "status", "percentage"]
ORACLE["filter_soft_delete"] = with_([src("property_schedule")], """
    SELECT propertyscheduleid, propertyid FROM src WHERE is_deleted = FALSE""")
ORACLE["schedule_four_way"] = with_(SCHEDULE, f"""
    SELECT property_id, project_id, project_name, property_name, {dbl('budget')} AS budget,
           {dbl('usedbudget')} AS usedbudget, scheduleid, phasename, {day('startdate')}
           AS startdate, {day('enddate')} AS enddate, status, {dbl('percentage')} AS percentage
    FROM x2""")
ORACLE["schedule_null_dates"] = with_(SCHEDULE, f"""
    SELECT scheduleid, {day('startdate')} AS startdate, {day('enddate')} AS enddate,
           {dkey('startdate')} AS start_date_key, {dkey('enddate')} AS end_date_key,
           CASE WHEN phasename IS NULL THEN 'missing phasename' END AS reject_reason
    FROM x2""")
ORACLE["dim_date"] = with_(SCHEDULE, f"""
    SELECT {dkey('d')} AS date_key, {day('d')} AS date,
           CAST(extract(year FROM d) AS INTEGER) AS year,
           CAST(extract(month FROM d) AS INTEGER) AS month,
           CAST(extract(day FROM d) AS INTEGER) AS day, monthname(d) AS month_name,
           CAST(extract(dow FROM d) AS INTEGER) AS day_of_week,
           CAST(extract(week FROM d) AS INTEGER) AS week_of_year,
           CAST(extract(quarter FROM d) AS INTEGER) AS quarter
    FROM (SELECT startdate AS d FROM x2 UNION SELECT enddate FROM x2) WHERE d IS NOT NULL""")
PROPERTY = best("x2", "property_id", SCHEDULE_ORDER, LAST)
ORACLE["dim_property_scd1"] = with_(SCHEDULE, f"""
    SELECT prop.k AS property_key, property_id, property_name, {dbl('budget')} AS budget,
           {dbl('usedbudget')} AS usedbudget
    FROM ({PROPERTY}) x JOIN prop ON prop.m = property_id""")
ORACLE["key_stability"] = with_(SCHEDULE, f"""
    SELECT property_id, prop_1.k AS first_key, prop.k AS second_key, property_name
    FROM ({PROPERTY}) x JOIN prop ON prop.m = property_id
    LEFT JOIN prop_1 ON prop_1.m = property_id""")
ORACLE["upsert_schedule"] = with_(
    [*SCHEDULE, ("won", best("(SELECT * FROM x2 WHERE phasename IS NOT NULL)", "scheduleid",
                             SCHEDULE_ORDER, LAST))], f"""
    SELECT scheduleid, prop.k AS property_key, proj.k AS project_key, phase.k AS phase_key,
           stat.k AS status_key, {dkey('startdate')} AS start_date_key,
           {dkey('enddate')} AS end_date_key, {dbl('percentage')} AS percentage
    FROM won JOIN prop ON prop.m = property_id JOIN proj ON proj.m = project_id
    JOIN phase ON phase.m = phasename JOIN stat ON stat.m = won.status""")

# Issues

ATTRIBUTES = {"issue_type": "dim_issue_type", "severity": "dim_severity",
              "priority": "dim_priority", "status": "dim_status",
              "reported_by_email": "dim_reporter"}
ISSUES = [
    src("issue_master", "im"), src("projects", "p1"), src("issue_projects", "p2"),
    src("properties", "pr"),
    ("early", f"SELECT * FROM im WHERE coalesce(updated_at < {ISSUE_SPLIT}, FALSE)"),
    *[cte for column, dim in ATTRIBUTES.items()
      for cte in members(dim, f"SELECT {column} AS m FROM early", f"SELECT {column} AS m FROM im")],
    *members("proj", *[f"SELECT project_id AS m FROM {x}" for x in ("early", "im")]),
    *members("prop", *[f"SELECT property_id AS m FROM {x} WHERE project_id IS NOT NULL"
                       for x in ("early", "im")]),
    ("rows_kept", """SELECT * FROM im WHERE project_id IS NOT NULL AND property_id IS NOT NULL
                     AND updated_at IS NOT NULL AND issue_id IS NOT NULL"""),
]
ATTRIBUTE_JOINS = " ".join(
    f"LEFT JOIN {dim} ON {dim}.m = x.{column}" for column, dim in ATTRIBUTES.items())
ATTRIBUTE_KEYS = """dim_issue_type.k AS issue_type_key, dim_severity.k AS severity_key,
    dim_priority.k AS priority_key, dim_status.k AS status_key, dim_reporter.k AS reporter_key"""
ORACLE["issues_left_join"] = with_(ISSUES, f"""
    SELECT im.issue_id, im.project_id, p1.project_name, im.property_id,
           pr.name AS property_name, im.reported_by_email, im.issue_type, im.severity,
           im.priority, im.status, {ts('im.updated_at')} AS updated_at
    FROM im LEFT JOIN p1 ON im.project_id = p1.project_id
    LEFT JOIN pr ON im.property_id = pr.propertyid""")
ORACLE["dim_issue_attrs"] = with_(ISSUES, " UNION ALL ".join(
    f"SELECT '{dim}' AS dimension, m AS member, k AS member_key FROM {dim}"
    for dim in ATTRIBUTES.values()))
ORACLE["dim_project_scd1"] = with_(ISSUES, """
    SELECT proj.k AS project_key, proj.m AS project_id, p2.project_name
    FROM proj LEFT JOIN p2 ON p2.project_id = proj.m""")
ORACLE["resolve_issues"] = with_(ISSUES, f"""
    SELECT x.issue_id, {ts('x.updated_at')} AS updated_at, {ATTRIBUTE_KEYS}
    FROM rows_kept x {ATTRIBUTE_JOINS}""")
ORACLE["upsert_issues"] = with_(
    [*ISSUES, ("x", best("rows_kept", "issue_id",
                         ["updated_at", "project_id", "property_id", *ATTRIBUTES], LAST))], f"""
    SELECT x.issue_id, proj.k AS project_key, prop.k AS property_key, {ATTRIBUTE_KEYS},
           {dkey('x.updated_at')} AS updated_date_key
    FROM x JOIN proj ON proj.m = x.project_id JOIN prop ON prop.m = x.property_id
    {ATTRIBUTE_JOINS}""")

# Worker payments

WORKERS = [
    ("wp", f"SELECT * FROM ({source_sql('worker_payments')}) WHERE payment_id IS NOT NULL"),
    ("early", f"SELECT * FROM wp WHERE {EARLY.format('created_at')}"),
    *members("worker", *[f"SELECT worker_id AS m FROM {x}" for x in ("early", "wp")]),
    *members("stat", *[f"SELECT status AS m FROM {x}" for x in ("early", "wp")]),
    *members("usr", *[f"SELECT created_by AS m FROM {x}" for x in ("early", "wp")]),
]
WORK_AMOUNTS = ("total_hours_worked", "total_sqft_completed", "total_days", "gross_amount",
                "tds_percent", "tds_amount", "net_amount")
ORACLE["key_assignment"] = with_(
    [src("worker_payments"), *members("x", "SELECT worker_name AS m FROM src")],
    "SELECT k AS reporter_key, m AS reported_by_email FROM x")
ORACLE["dim_worker_scd1"] = with_(WORKERS, f"""
    SELECT worker.k AS worker_key, worker_id, worker_name, worker_type
    FROM ({best('wp', 'worker_id', ['created_at', 'worker_name', 'worker_type', 'payment_id'],
                LAST)}) x JOIN worker ON worker.m = worker_id""")
ORACLE["resolve_worker_dates"] = with_([*WORKERS, src("core_dim_date", "days")], f"""
    SELECT payment_id, {day("created_at")} AS created_date,
           CAST(date_key AS INTEGER) AS created_date_key
    FROM wp JOIN days ON full_date = CAST(created_at AS DATE)""")
ORACLE["strict_date_misses"] = with_([*WORKERS, src("shipping_dates", "days")], f"""
    SELECT {day('created_at')} AS value, count(*) AS n_rows FROM wp
    WHERE CAST(created_at AS DATE) NOT IN (SELECT full_date FROM days) GROUP BY 1""")
ORACLE["upsert_worker_payments"] = with_(WORKERS, f"""
    SELECT payment_id, worker.k AS worker_key, work_duration_type,
           {', '.join(f'{dbl(c)} AS {c}' for c in WORK_AMOUNTS)}, payment_mode,
           stat.k AS status_key, usr.k AS created_by_key, {dkey('created_at')} AS created_date_key
    FROM wp LEFT JOIN worker ON worker.m = worker_id JOIN stat ON stat.m = wp.status
    LEFT JOIN usr ON usr.m = created_by""")

# Payloads

SHAPED = "regexp_full_match(requested_date, '[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}')"
PADDED = """split_part(requested_date, '-', 1) || '-' ||
            lpad(split_part(requested_date, '-', 2), 2, '0') || '-' ||
            lpad(split_part(requested_date, '-', 3), 2, '0')"""
PAYLOAD = [
    src("payload_records"),
    ("parsed", f"""SELECT *, CASE WHEN {SHAPED} THEN TRY_CAST({PADDED} AS DATE) END AS d,
                          coalesce(CAST(number_quantity AS DOUBLE),
                                   TRY_CAST(text_quantity AS DOUBLE)) AS q FROM src"""),
    ("judged", """SELECT *, CASE
            WHEN request_id = '' OR item_name = '' OR location = '' OR number_quantity = 0
              OR text_quantity = '' THEN 'incomplete'
            WHEN d IS NULL THEN 'bad requested_date'
            WHEN q IS NULL THEN 'bad quantity' END AS reject_reason FROM parsed"""),
    ("offers", """SELECT * FROM judged
                  WHERE coalesce(reject_reason, '') NOT IN ('incomplete', 'bad requested_date')"""),
    ("a", f"SELECT * FROM offers WHERE arrived_at < {SPLIT}"),
    *members("item", "SELECT item_name AS m FROM a", "SELECT item_name AS m FROM offers"),
    *members("proj", "SELECT location AS m FROM a", "SELECT location AS m FROM offers"),
    ("won", best("(SELECT * FROM judged WHERE reject_reason IS NULL)", "request_id",
                 ["arrived_at", "payload_id", "position"], LAST)),
]
ORACLE["payload_explode"] = with_(PAYLOAD, """
    SELECT payload_id, position, request_id, item_name, location, requested_date, q AS quantity
    FROM parsed""")
ORACLE["parse_payload_date"] = with_(PAYLOAD, """
    SELECT payload_id, position, requested_date, CAST(d AS VARCHAR) AS parsed FROM parsed""")
ORACLE["complete_payload"] = with_(
    PAYLOAD, "SELECT payload_id, position, reject_reason FROM judged")
ORACLE["upsert_payload"] = with_(PAYLOAD, f"""
    SELECT request_id, item.k AS item_key, q AS quantity, proj.k AS project_key,
           {dkey('d')} AS date_key
    FROM won JOIN item ON item.m = item_name JOIN proj ON proj.m = location""")

ORACLE["check_dimensions"] = with_([src("members")], """
    SELECT 'repeated vendor_key' AS problem, count(*) AS n_rows
    FROM (SELECT vendor_key FROM src GROUP BY vendor_key HAVING count(*) > 1) x
    UNION ALL SELECT 'vendor_id too long', count(*) FROM src WHERE length(vendor_id) > 20
    HAVING count(*) > 0""")
ORACLE["fine_amounts"] = with_([src("fine_inventory")], """
    SELECT inventory_id,
           CASE WHEN quantity = '0.0000000000000000001' THEN 'bad quantity' ELSE 'loaded' END AS outcome,
           CASE WHEN quantity <> '0.0000000000000000001'
                THEN CAST(CAST(quantity AS DECIMAL(38,18)) * 10000000 AS DOUBLE) END AS ten_millionths
    FROM src""")

# Published tables hold what the session's do.
for _name, _same in (("inventory", "upsert_inventory"), ("requests", "insert_new_requests"),
                     ("payments", "insert_absent_payments")):
    ORACLE[f"published_{_name}"] = ORACLE[_same]
ORACLE["published_request_keys"] = f"""
    SELECT count(*) AS n_keys, count(*) AS n_different FROM ({ORACLE['insert_new_requests']}) x"""

ORACLE["last_payment_wins"] = with_([src("repeated_payments")], f"""
    SELECT payment_id, work_duration_type, {dbl('total_hours_worked')} AS total_hours_worked,
           {dbl('gross_amount')} AS gross_amount, {dkey('created_at')} AS created_date_key
    FROM ({best('src', 'payment_id', ['created_at', 'worker_id', 'worker_name', 'worker_type',
                                      'work_duration_type', 'total_hours_worked'], LAST)}) x""")
ORACLE["bad_requests"] = with_([
    src("bad_requests"), src("known_items", "items"), src("known_projects", "projects"),
    src("known_properties", "properties"),
    *members("itype", "SELECT CASE WHEN trim(item_type, ' ') <> '' THEN item_type END AS m FROM src"),
    ("judged", """
        SELECT *, CASE WHEN trim(status, ' ') = '' THEN 'unknown status'
                       WHEN itype.k IS NULL THEN 'unknown item_type'
                       WHEN project_name NOT IN (SELECT project_name FROM projects)
                         THEN 'unknown project_name'
                       WHEN property_name NOT IN (SELECT property_name FROM properties)
                         THEN 'unknown property_name'
                       WHEN item_name NOT IN (SELECT item_name FROM items) THEN 'unknown item_name'
                       WHEN requested_quantity = 'many' THEN 'bad quantity' ELSE 'loaded' END AS outcome
        FROM src LEFT JOIN itype ON itype.m = item_type""")], """
    SELECT outcome, k AS item_type_key, count(*) AS n_rows,
           sum(TRY_CAST(requested_quantity AS DOUBLE)) AS quantity
    FROM judged GROUP BY outcome, k""")
