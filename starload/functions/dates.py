"""Date keys, calendar attributes and strict date text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(value: Column) -> Column:
    """yyyymmdd as an integer; NULL stays NULL."""
    year = F.year(value)
    # Counted where the text would have eight digits, which costs less than writing it.
    return F.when(
        year.between(1, 9999), year * 10000 + F.month(value) * 100 + F.dayofmonth(value)
    ).otherwise(F.date_format(value, "yyyyMMdd").cast("int"))


def calendar(date: Column) -> list[Column]:
    """All attributes of a ``d_date`` member. Sunday is day 0, weeks are ISO weeks."""
    return [
        date_key(date).alias("date_key"),
        date.alias("date"),
        F.year(date).alias("year"),
        F.month(date).alias("month"),
        F.dayofmonth(date).alias("day"),
        F.date_format(date, "MMMM").alias("month_name"),
        (F.dayofweek(date) - 1).alias("day_of_week"),
        F.weekofyear(date).alias("week_of_year"),
        F.quarter(date).alias("quarter"),
    ]


def strict_date(text: Column) -> Column:
    """``yyyy-m-d`` with one or two digits for month and day, else NULL."""
    # The earliest year a calendar date can hold is 1. Months and days out of range are told by
    # their shape, as a parser that fails costs far more than one that does not.
    shaped = text.rlike(r"\A(?!0000)[0-9]{4}-(0?[1-9]|1[0-2])-(0?[1-9]|[12][0-9]|3[01])\z")
    return F.when(shaped, text).try_cast("date")
