"""Batch reduction by key, and merging a batch into a target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class Conflict(RuntimeError):
    """Another writer published the table meanwhile; running the load again is safe."""


def total_order(df: DataFrame, first: Sequence[str], skip: Sequence[str] = ()) -> list[str]:
    """``first``, then every other column, so that only equal rows can tie.

    ``skip`` names columns that cannot differ where the others are equal.
    """
    return [*first, *[c for c in df.columns if c not in first and c not in skip]]


def _one_per_key(df: DataFrame, key: Sequence[str], order: list[Column]) -> DataFrame:
    # The rank filter is applied per input partition before the shuffle, so a
    # key that holds much of the data sends one row per task, not all its rows.
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def last_wins(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that a row-by-row upsert in this order would leave."""
    return _one_per_key(df, key, [F.col(c).desc_nulls_first() for c in order])


def first_wins(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that a row-by-row insert in this order would store."""
    return _one_per_key(df, key, [F.col(c).asc_nulls_last() for c in order])


def upsert(target: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """``target`` with the rows of ``batch`` added or put in place of theirs."""
    return target.join(batch.select(*key), list(key), "left_anti").unionByName(batch)


def absent(batch: DataFrame, target: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` whose key the target does not hold."""
    return batch.join(target.select(*key), list(key), "left_anti")
