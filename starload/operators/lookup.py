"""Natural key to surrogate key, with three ways to treat an unknown member."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.operators.clean import classify
from starload.session import FEW


class UnknownMember(ValueError):
    """A strict lookup met values the dimension does not hold."""


@dataclass(frozen=True)
class Lookup:
    """Find ``key`` of ``dimension`` where ``natural`` equals the row's ``column``."""

    column: str
    dimension: DataFrame
    natural: str
    key: str
    output: str


def few_values(tables, rows: DataFrame, *columns: str) -> dict[str, list] | None:
    """The values in the columns of a batch of at most ``FEW`` rows, as text; None for a larger one.

    A small batch, such as one of a stream, reads of a large dimension only its own members.
    None, too, for tables that cannot be read by member.
    """
    if not tables.by_member:
        return None
    found = rows.select(*[F.col(c).cast("string").alias(c) for c in columns]).limit(FEW + 1).collect()
    if len(found) > FEW:
        return None
    return {c: sorted({r[c] for r in found if r[c] is not None}) for c in columns}


def by_name(dimension: DataFrame, name: str, key: str) -> DataFrame:
    """One key per name, the lowest, for dimensions whose names may repeat."""
    return dimension.groupBy(name).agg(F.min(key).alias(key))


def or_null(df: DataFrame, lookups: list[Lookup]) -> DataFrame:
    """Add the keys; an unknown or NULL member gives a NULL key.

    The join strategy is left to the size the optimizer measures. A dimension
    too large to broadcast is joined by shuffle, where adaptive execution splits
    the partitions of hot members.
    """
    for one in lookups:
        side = one.dimension.select(
            F.col(one.natural).alias("_natural"), F.col(one.key).alias(one.output)
        )
        value = F.col(one.column).cast(side.schema["_natural"].dataType)
        df = df.join(side, value == side["_natural"], "left").drop("_natural")
    return df


def or_reject(df: DataFrame, lookups: list[Lookup]) -> DataFrame:
    """Add the keys and reject a row for the first member not found."""
    found = or_null(df, lookups)
    return classify(
        found, [(f"unknown {one.column}", F.col(one.output).isNotNull()) for one in lookups]
    )


def misses(df: DataFrame, lookup: Lookup) -> DataFrame:
    """Values without a member, NULL included, and the rows that hold them."""
    side = lookup.dimension.select(F.col(lookup.natural).alias("_natural"))
    value = F.col(lookup.column).cast(side.schema["_natural"].dataType)
    counted = df.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.join(side, counted["value"] == side["_natural"], "left_anti")


def or_fail(df: DataFrame, lookup: Lookup) -> DataFrame:
    """Add the key; raise before anything is returned if a member is unknown."""
    examples = misses(df, lookup).orderBy("value").limit(5).collect()
    if examples:
        values = ", ".join(str(row["value"]) for row in examples)
        raise UnknownMember(f"no {lookup.output} for {lookup.column}: {values}")
    return or_null(df, [lookup])
