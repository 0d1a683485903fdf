"""What keeps the loads' time and volume in proportion to their rows."""

import contextlib
import io
import re
from decimal import Decimal

from pyspark.sql import functions as F

from starload.functions.dates import date_key, strict_date
from starload.functions.truth import truthy
from starload.operators import clean
from starload.plans import inventory, payload
from starload.session import materialize
from starload.sources.tables import SessionTables


def records(spark):
    rows = [("a", '[{"request_id":"R1","item_name":"x","quantity":1.5,"location":"l","requested_date":"2024-2-29"}]'),
            ("b", '[{"other":1}, 3, []]')]
    return materialize(spark.createDataFrame(rows, "path string, body string").select(
        F.struct(F.lit("2024-01-01").cast("timestamp").alias("at"), "path").alias("arrival"),
        F.parse_json("body").alias("records")), "documents")


def test_payload_rules_are_compiled(spark):
    checked = payload.check(records(spark))
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        checked.explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", shown.getvalue())]
    # Java never compiles a method of more than 8,000 bytes.
    assert sizes and max(sizes) < 8000
    got = {(r["arrival"]["path"], r["position"]): r[clean.REASON] for r in checked.collect()}
    assert got == {("a", 0): None, ("b", 0): "incomplete", ("b", 1): "not an object",
                   ("b", 2): "not an object"}


def test_strict_dates_at_their_ends(spark):
    texts = ["0000-01-01", "0001-1-1", "2023-02-29", "2024-02-29", "2024-13-01", "2024-00-10", "2024-1-32",
             "2024-4-31", "2024-01-001", " 2024-01-01", "9999-12-31", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r["t"]: r["d"] for r in rows.select("t", strict_date(F.col("t")).cast("string").alias("d")).collect()}
    assert {t for t, d in got.items() if d} == {"0001-1-1", "2024-02-29", "9999-12-31"}
    assert got["0001-1-1"] == "0001-01-01"


def test_date_keys_beyond_four_digits(spark):
    day = spark.sql("SELECT DATE'2024-03-05' AS a, DATE'+12024-03-05' AS b, CAST(NULL AS DATE) AS c")
    got = day.select(*[date_key(F.col(c)).alias(c) for c in "abc"]).first()
    assert (got["a"], got["b"], got["c"]) == (20240305, 120240305, None)


def test_truth_of_texts_that_look_like_json(spark):
    values = ['""', '"[]"', '"{}"', '"false"', "false", "true", "[]", "{}", "[0]", '{"a":0}', "0", "0.0", "-1",
              "null", '" "']
    rows = spark.createDataFrame([(v,) for v in values], "v string")
    got = {r["v"] for r in rows.filter(truthy(F.parse_json("v"))).collect()}
    assert got == {'"[]"', '"{}"', '"false"', "true", "[0]", '{"a":0}', "-1", '" "'}


def test_amounts_by_their_digits_before_the_point(spark):
    fits = [("decimal(38,6)", "99999999999999999999.999999"), ("decimal(38,18)", "9" * 20 + "." + "9" * 18)]
    misses = [("decimal(38,6)", "100000000000000000000.000000"), ("decimal(38,0)", "9" * 38)]
    for cases, kept in ((fits, 3), (misses, 1)):
        for dtype, most in cases:
            rows = spark.createDataFrame([(most,), ("-" + most,), (None,)], "t string").select(
                F.col("t").cast(dtype).alias("n"))
            assert rows.filter(clean.fits_amount(rows, "n")).count() == kept


def test_batches_are_reduced_once(spark):
    rows = spark.createDataFrame(
        [(str(i % 3), "item", Decimal(i), "place", f"2024-01-0{i + 1} 00:00:00") for i in range(6)],
        "inventory_id string, item_name string, quantity decimal(38,6), location string, updated_date string",
    ).withColumn("updated_date", F.col("updated_date").cast("timestamp"))
    tables = SessionTables(spark)
    for part in (rows.limit(2), rows):
        inventory.load(part, tables)
    fact = tables.read("f_inventory")
    # Neither the reduction nor the lookups run again for each reader of the fact.
    assert "Window" not in fact._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r["inventory_id"], int(r["quantity"])) for r in fact.collect()) == [
        ("0", 3), ("1", 4), ("2", 5)]
