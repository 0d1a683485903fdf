"""Snapshot reads of operational tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.session import materialize


def scan(
    spark: SparkSession, location: str, columns: Sequence[str] | Mapping[str, str],
    source_format: str = "parquet", **options: str,
) -> DataFrame:
    """Named columns of a file set or, with ``source_format="table"``, a table.

    ``columns`` is a list, or a mapping from the output name to the source name.
    """
    if source_format == "table":
        df = spark.read.table(location)
    else:
        df = spark.read.format(source_format).options(**options).load(location)
    return project(df, columns)


def project(df: DataFrame, columns: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Column list with aliases."""
    pairs = columns.items() if isinstance(columns, Mapping) else [(c, c) for c in columns]
    return df.select(*[F.col(source).alias(name) for name, source in pairs])


def scan_jdbc(
    spark: SparkSession, url: str, table: str, columns: Sequence[str] | Mapping[str, str],
    split_on: str, partitions: int, **options: str,
) -> DataFrame:
    """A copy of a database table, read by ``partitions`` tasks over ``split_on``.

    ``split_on`` must be a number, a date or a time: of a table keyed by text, the time a
    row was made or changed. Rows come ``fetchsize`` at a time (10,000 unless given), as a
    driver may else hold all rows of a task.

    The range bounds are asked from the database. The copy is made once, as a
    load passes over its source several times and the table may change meanwhile.
    The driver jar of the database must be on the class path.
    """
    options = {"fetchsize": "10000", **options}
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    ends = (
        reader.option("query", f"SELECT MIN({split_on}) AS lo, MAX({split_on}) AS hi FROM {table}")
        .load().first()
    )
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    reader = reader.option("dbtable", table)
    if ends["lo"] is not None:
        reader = (
            reader.option("partitionColumn", split_on).option("numPartitions", str(partitions))
            .option("lowerBound", str(ends["lo"])).option("upperBound", str(ends["hi"]))
        )
    return materialize(project(reader.load(), columns), "scan")
