"""Text predicates and LIKE patterns built from data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nonblank(value: Column) -> Column:
    """Neither NULL nor spaces only. Tabs count as text."""
    return F.coalesce(F.trim(value) != "", F.lit(False))


def present(value: Column) -> Column:
    """Neither NULL nor the empty string; spaces count as a value."""
    return F.coalesce(value != "", F.lit(False))


def containing_pattern(name: Column) -> Column:
    """LIKE pattern for texts that contain ``name``, read as a pattern itself.

    A backslash keeps its meaning before a wildcard or another backslash and is
    dropped before any other character, which Spark would refuse. This runs on
    the finished pattern, as a last backslash escapes the closing wildcard.
    """
    pattern = F.concat(F.lit("%"), name, F.lit("%"))
    return F.regexp_replace(pattern, r"(?s)(\\[%_\\])|\\(.)", "$1$2")


def pattern_fragments(name: Column) -> Column:
    """The literal runs of a containing pattern, escapes resolved."""
    runs = F.regexp_extract_all(
        F.concat(name, F.lit("%")), F.lit(r"(?s)((?:[^%_\\]|\\.)+)"), F.lit(1)
    )
    return F.transform(runs, lambda run: F.regexp_replace(run, r"(?s)\\(.)", "$1"))


def decimals(number: Column) -> Column:
    """Places after the point that a number written as text uses, its exponent included."""
    digits = F.rtrim(F.regexp_extract(number, r"\.([0-9]*)", 1), F.lit("0"))
    power = F.regexp_extract(number, r"[eE]([+-]?[0-9]+)", 1).try_cast("int")
    zeros = F.length(F.regexp_extract(number, r"^[^.]*?(0*)[eE]", 1))
    short = F.when(digits == "", -zeros).otherwise(F.length(digits))
    plain = ~F.contains(number, F.lit("e")) & ~F.contains(number, F.lit("E"))
    # Few numbers have an exponent; whole ones without it use no place.
    return (
        F.when(plain & ~F.contains(number, F.lit(".")), F.lit(0))
        .when(plain, F.length(digits))
        .otherwise(short - F.coalesce(power, F.lit(0)))
    )
