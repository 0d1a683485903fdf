"""Run queries beside their SQL and report the differences.

    python -m testbed.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from testbed.oracle import ORACLE
from testbed.queries import QUERIES
from testbed.sources import TEST_TABLES


def cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return str(value) if value is not None and not isinstance(value, (int, bool)) else value


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(cell(r[i]) for i in order)) for r in rows)


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TEST_TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def expected(con, name: str):
    result = con.execute(ORACLE[name])
    return normal(result.fetchall(), [c[0] for c in result.description]), sorted(
        c[0] for c in result.description
    )


def actual(spark: SparkSession, sf_dir: str, name: str):
    df = QUERIES[name](spark, sf_dir)
    return normal(df.collect(), df.columns), sorted(df.columns)


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            got, columns = actual(spark, sf_dir, name)
            want, want_columns = expected(con, name)
            ok = got == want and columns == want_columns
            print(f"{'ok  ' if ok else 'DIFF'} {name} {len(got)}/{len(want)} rows "
                  f"{time.time() - start:.1f}s", flush=True)
            if not ok:
                bad += 1
                only = [r for r in got if r not in set(want)][:3]
                missing = [r for r in want if r not in set(got)][:3]
                print("  columns", columns, want_columns, "\n  got ", only, "\n  want", missing)
        except Exception as error:  # noqa: BLE001
            bad += 1
            print(f"FAIL {name}: {str(error)[:1500]}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
