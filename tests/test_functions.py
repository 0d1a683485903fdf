import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import day, frame, rows
from starload.functions.dates import calendar, strict_date
from starload.functions.text import nonblank, present
from starload.functions.truth import is_scalar, truthy


@pytest.mark.parametrize("text, want", [
    ("2025-07-01", "2025-07-01"), ("2025-7-1", "2025-07-01"), ("2024-02-29", "2024-02-29"),
    ("0001-01-01", "0001-01-01"), ("2025-13-01", None), ("2025-02-29", None),
    ("2025-007-01", None), ("2025-07-01x", None), ("2025-07- 1", None), (" 2025-07-01", None),
    ("25-07-01", None), ("0000-01-01", None), ("2025-07-01\n", None), ("", None), (None, None),
    ("2025-00-10", None), ("2025-10-00", None),
])
def test_strict_date(spark, text, want):
    got = frame(spark, "t string", (text,)).select(strict_date(F.col("t"))).first()[0]
    assert got == (day(want) if want else None)


def test_calendar(spark):
    dates = [day("2023-01-01"), day("2024-12-30"), day("2024-02-29")]
    df = frame(spark, "d date", *[(d,) for d in dates]).select(*calendar(F.col("d")))
    for r in df.collect():
        d = r["date"]
        assert r["date_key"] == int(d.strftime("%Y%m%d"))
        assert (r["year"], r["month"], r["day"]) == (d.year, d.month, d.day)
        assert r["month_name"] == d.strftime("%B")
        assert r["day_of_week"] == d.isoweekday() % 7
        assert r["week_of_year"] == d.isocalendar().week
        assert r["quarter"] == (d.month + 2) // 3


def test_blank_and_present(spark):
    df = frame(spark, "t string", (None,), ("",), ("  ",), ("\t",), ("a",))
    got = [tuple(r) for r in df.select(nonblank(F.col("t")), present(F.col("t"))).collect()]
    assert got == [(False, False), (False, False), (False, True), (True, True), (True, True)]


@pytest.mark.parametrize("text", [
    "null", "false", "true", "0", "-0.0", "0e5", "1", "0.1", '""', '"0"', '" "', "[]", "[null]",
    "{}", '{"a": null}', "100000000000000000000", "1e-3", '"false"', '"[]"',
])
def test_truth_of_json_values(spark, text):
    value = F.parse_json(F.col("t"))
    got = frame(spark, "t string", (text,)).select(truthy(value), is_scalar(value)).first()
    want = json.loads(text)
    assert got[0] == bool(want)
    assert got[1] == isinstance(want, (str, int, float))


def test_absent_field_is_not_true(spark):
    df = frame(spark, "t string", ("{}",))
    field = F.try_variant_get(F.parse_json(F.col("t")), "$.x", "variant")
    assert rows(df.select(truthy(field))) == [(False,)]


def test_strict_date_as_the_parser_of_the_source(spark):
    pick = random.Random(5)
    texts = {
        f"{pick.choice([1, 24, 1999, 2024, 20245])}{pick.choice('--/')}"
        f"{pick.choice(['', '0', '00'])}{pick.randrange(14)}-"
        f"{pick.choice(['', '0'])}{pick.randrange(33)}{pick.choice(['', '', '', ' ', 'T0'])}"
        for _ in range(3000)
    }

    def parsed(text):
        try:
            return datetime.strptime(text, "%Y-%m-%d").date()
        except ValueError:
            return None

    df = frame(spark, "t string", *[(t,) for t in texts])
    got = {r["t"]: r["d"] for r in df.select("t", strict_date(F.col("t")).alias("d")).collect()}
    assert got == {t: parsed(t) for t in texts}
    assert sum(d is not None for d in got.values()) > 50
