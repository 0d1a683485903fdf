"""Row checks: every row gets the first reason it is rejected for, or none."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.functions.text import decimals
from starload.schemas import AMOUNT

REASON = "reject_reason"


def classify(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """Add the name of the first rule a row breaks; NULL when it passes all.

    A rule is a name and a condition that must hold. An unknown condition counts
    as broken. A reason found by an earlier call is kept.
    """
    found = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules]
    earlier = [F.col(REASON)] if REASON in df.columns else []
    return df.withColumn(REASON, F.coalesce(*earlier, *found))


def kept(df: DataFrame, *present: str) -> DataFrame:
    """Rows that passed every check.

    ``present`` names columns no such row lacks; unlike the checks as a whole,
    this can be tested by the scan.
    """
    return required(df, *present).filter(F.col(REASON).isNull()).drop(REASON)


def rejects(df: DataFrame, job: str, key: str) -> DataFrame:
    """Rejected rows as (job, key, reason)."""
    return df.filter(F.col(REASON).isNotNull()).select(
        F.lit(job).alias("job"), F.col(key).cast("string").alias("key"),
        F.col(REASON).alias("reason"),
    )


def counters(df: DataFrame) -> DataFrame:
    """Rows per outcome: one line for the loaded ones and one per reason."""
    return df.groupBy(F.coalesce(F.col(REASON), F.lit("loaded")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def required(df: DataFrame, *columns: str) -> DataFrame:
    """Rows that have a value in every named column.

    Written as single tests, which reach the scan; ``dropna`` does not.
    """
    for column in columns:
        df = df.filter(F.col(column).isNotNull())
    return df


def live(df: DataFrame, flag: str) -> DataFrame:
    """Rows not marked deleted; an unknown mark is not read."""
    return df.filter(F.col(flag) == F.lit(False))


def fits_amount(df: DataFrame, *columns: str) -> Column:
    """NULL, or a number the amount type holds without changing it, in each column."""
    test = F.lit(True)
    for column in columns:
        value, dtype = F.col(column), df.schema[column].dataType
        if isinstance(dtype, T.DecimalType) and dtype.scale <= AMOUNT.scale:
            # No place is lost, so that only the digits before the point count.
            digits = AMOUNT.precision - AMOUNT.scale
            if dtype.precision - dtype.scale > digits:
                # Compared on both sides: ``abs`` would round beyond 34 digits.
                bound = Decimal(10) ** digits
                test = test & (value.isNull() | ((value < F.lit(bound)) & (value > F.lit(-bound))))
            continue
        amount = value.try_cast(AMOUNT)
        if isinstance(dtype, T.StringType):
            same = amount.isNotNull() & (decimals(value) <= AMOUNT.scale)
        else:
            same = F.coalesce(amount.try_cast(dtype) == value, F.lit(False))
        test = test & (value.isNull() | same)
    return test
