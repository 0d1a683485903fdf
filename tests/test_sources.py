import pytest

from helpers import frame, rows
from starload.plans.requests import EMPLOYEE
from starload.sources.scan import scan, scan_jdbc

STAFF = ("employee_code string, first_name string, last_name string, email string, note string",
         ("e1", "A", "B", "a@x", "n"))


@pytest.mark.parametrize("source_format", ["parquet", "csv", "json", "orc"])
def test_files(spark, tmp_path, source_format):
    path = str(tmp_path / source_format)
    frame(spark, *STAFF).write.format(source_format).option("header", True).save(path)
    options = {"header": "true"} if source_format == "csv" else {}
    got = scan(spark, path, EMPLOYEE, source_format, **options)
    assert got.columns == ["emp_id", "first_name", "last_name", "email"]
    assert rows(got) == [("e1", "A", "B", "a@x")]


def test_table(spark):
    frame(spark, *STAFF).createOrReplaceTempView("staff")
    assert rows(scan(spark, "staff", ["employee_code"], "table")) == [("e1",)]


def test_database_needs_its_driver(spark):
    with pytest.raises(Exception, match="(?i)driver"):
        scan_jdbc(spark, "jdbc:postgresql://nowhere/db", "t", ["a"], "a", 4)
