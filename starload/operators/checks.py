"""Constraints Parquet cannot hold: unique keys, references, text lengths."""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.schemas import TABLES


class ConstraintViolation(ValueError):
    """Rows about to be published break the contract of their table."""


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their number of rows."""
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.filter("n_rows > 1")


def orphans(df: DataFrame, column: str, target: DataFrame, key: str) -> DataFrame:
    """Values of ``column`` without a row in ``target``, with their number of rows."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    side = target.select(F.col(key).alias("_key"))
    return counted.join(side, counted["value"] == side["_key"], "left_anti")


def too_long(df: DataFrame, table: str) -> DataFrame:
    """Rows per column whose text is longer than declared."""
    lengths = TABLES[table].lengths
    pairs = [
        F.struct(F.lit(c).alias("column"), F.coalesce(F.char_length(c) > n, F.lit(False)).alias("long"))
        for c, n in lengths.items()
    ]
    return (
        df.select(F.explode(F.array(*pairs)).alias("pair")).filter("pair.long")
        .groupBy(F.col("pair.column").alias("column")).agg(F.count(F.lit(1)).alias("n_rows"))
    )


def verify_members(rows: DataFrame, table: str) -> int:
    """Raise if members repeat a natural or a surrogate key or are too long.

    Members without a natural key may be many, as UNIQUE allows. Returns the highest
    surrogate key, 0 for none. ``rows`` should be a written table.
    """
    contract = TABLES[table]
    found = [
        repeated_keys(rows.dropna(subset=list(key)), key).select(
            F.lit(f"repeated {', '.join(key)}").alias("problem")).limit(1)
        for key in (contract.natural, (contract.surrogate,))
    ]
    if contract.lengths:
        found.append(
            too_long(rows, table).select(F.concat("column", F.lit(" too long")).alias("problem"))
        )
    top = rows.agg(F.max(contract.surrogate).cast("string").alias("problem"))
    lines = functools.reduce(DataFrame.unionByName, [f.withColumn("top", F.lit(False)) for f in found])
    # One line per broken rule, and one with the highest key.
    lines = lines.unionByName(top.withColumn("top", F.lit(True))).collect()
    problems = [r["problem"] for r in lines if not r["top"]]
    if problems:
        raise ConstraintViolation(f"{table}: " + "; ".join(problems))
    return int(next(r["problem"] for r in lines if r["top"]) or 0)


def missing_references(
    rows: DataFrame, references: dict[str, tuple[str, str]], read: Callable[[str], DataFrame]
) -> DataFrame:
    """(target, value, column) of keys without a row in their table.

    The keys of all columns are reduced together before a single shuffle.
    """
    keys = [
        F.struct(F.lit(target).alias("target"), F.col(column).cast("long").alias("value"),
                 F.lit(column).alias("column"))
        for column, (target, _) in references.items()
    ]
    used = rows.select(F.explode(F.array(*keys)).alias("k")).select("k.*").filter(
        "value IS NOT NULL").distinct()
    stored = functools.reduce(DataFrame.unionByName, [
        read(target).select(F.lit(target).alias("target"), F.col(key).cast("long").alias("value"))
        for target, key in sorted(set(references.values()))
    ])
    return used.join(stored, ["target", "value"], "left_anti")


def verify(rows: DataFrame, table: str, read: Callable[[str], DataFrame]) -> None:
    """Raise if rows to be merged repeat a key, miss a reference or are too long.

    Only the batch is checked: stored rows were checked when they came, and the
    merge removes or keeps them by key.
    """
    contract = TABLES[table]
    found = [
        repeated_keys(rows, contract.natural).select(
            F.lit(f"repeated {', '.join(contract.natural)}").alias("problem")
        ).limit(1)
    ]
    if contract.references:
        found.append(missing_references(rows, contract.references, read).select(
            F.concat("column", F.lit(" without a row in "), "target").alias("problem")).distinct())
    if contract.lengths:
        found.append(
            too_long(rows, table).select(F.concat("column", F.lit(" too long")).alias("problem"))
        )
    # One line per broken rule at most reaches the driver.
    problems = [r["problem"] for r in functools.reduce(DataFrame.unionByName, found).collect()]
    if problems:
        raise ConstraintViolation(f"{table}: " + "; ".join(problems))
