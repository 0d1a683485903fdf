"""Dimension members: insert what is new, overwrite attributes, purge blanks."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.functions.dates import calendar
from starload.functions.text import nonblank
from starload.operators.clean import required
from starload.operators.keys import assign_keys, number_groups
from starload.operators.merge import absent, first_wins, last_wins, total_order
from starload.schemas import TABLES, conform
from starload.session import FEW, materialize


Offers = dict[tuple[str, str], Column | list[Column]]


def offers(rows: DataFrame, values: Offers) -> DataFrame:
    """Distinct members as (dim, member), for several dimensions in a single pass.

    ``values`` maps (dimension, natural column) to the value a row offers, or to
    several; NULL offers none. Duplicates are dropped before the shuffle.
    """
    found = [
        F.struct(F.lit(table).alias("dim"), value.cast("string").alias("member"))
        for (table, _), columns in values.items()
        for value in (columns if isinstance(columns, list) else [columns])
    ]
    offered = rows.select(F.explode(F.array(*found)).alias("offer")).select("offer.*")
    return offered.filter("member IS NOT NULL").distinct()


def new_members(
    offered: DataFrame, values: Iterable[tuple[str, str]], targets: dict[str, DataFrame],
    tops: dict[str, int | None] | None = None,
) -> dict[str, DataFrame]:
    """The offered members that are new, for dates and one-column dimensions.

    Members that exist keep their key; new ones are keyed in their order, above the highest
    key that ``tops`` has for their table or, without it, that is in use.
    """
    values = list(values)
    stored = functools.reduce(DataFrame.unionByName, [
        targets[table].select(
            F.lit(table).alias("dim"), F.col(natural).cast("string").alias("member"),
            F.col(TABLES[table].surrogate).cast("long").alias("key"),
        )
        for table, natural in values
    ])
    label = "members-" + "-".join(table for table, _ in values)
    fresh = absent(offered, stored, ["dim", "member"])
    numbered, first = number_groups(fresh, "dim", ["member"], label)
    tops = dict(tops or {})
    if any(tops.get(table) is None for table, _ in values):
        # One row per dimension reaches the driver.
        used = stored.groupBy("dim").agg(F.max("key").alias("top")).collect()
        tops = {r["dim"]: r["top"] for r in used} | {t: n for t, n in tops.items() if n is not None}

    def members(table: str, natural: str) -> DataFrame:
        own = numbered.filter(F.col("dim") == table)
        if table == "d_date":
            return own.select(*calendar(F.col("member").cast("date")))
        shift = (tops.get(table) or 0) + 1 - first.get(table, 0)
        key = (F.col("_position") + F.lit(shift)).alias(TABLES[table].surrogate)
        return conform(own.select(key, F.col("member").alias(natural)), table)

    return {table: members(table, natural) for table, natural in values}


def stored_members(tables, table: str, natural: str, values: list | None) -> DataFrame:
    """The stored members with one of a few values; all of them for None, or where the highest
    key must be found among them."""
    return tables.members(table, natural, None if tables.top(table) is None else values)


def insert_members(
    offered: DataFrame, values: Iterable[tuple[str, str]], tables, few: dict[str, list] | None = None,
) -> None:
    """Add the new ones of the offered members to the target tables.

    ``few`` has all the values that are offered to a table, by its name, if they are few.
    """
    values = list(values)
    targets = {table: stored_members(tables, table, natural, (few or {}).get(table))
               for table, natural in values}
    tops = {table: tables.top(table) for table, _ in values}
    for table, new in new_members(offered, values, targets, tops).items():
        tables.append(table, new)


def _identified(rows: DataFrame, table: str) -> DataFrame:
    """Rows that name their member, with the natural key in the type of the table."""
    contract = TABLES[table]
    types = dict(contract.columns)
    rows = required(rows, *contract.natural)
    return rows.withColumns({c: F.col(c).cast(types[c]) for c in contract.natural})


def first_seen(
    rows: DataFrame, table: str, target: DataFrame, order: Sequence[str] = (),
    top: int | None = None,
) -> DataFrame:
    """New members with attributes; the first row of a member gives them."""
    contract = TABLES[table]
    natural = list(contract.natural)
    rows = _identified(rows, table)
    first = first_wins(rows, natural, total_order(rows, order, natural))
    members = absent(first, target, natural).select(
        *[c for c in contract.names if c in rows.columns]
    )
    return conform(assign_keys(members, target, contract.surrogate, natural, table, top), table)


def changed_members(
    rows: DataFrame, table: str, target: DataFrame, attributes: Sequence[str],
    order: Sequence[str] = (), top: int | None = None,
) -> DataFrame:
    """New members, and those whose attributes change, as they are afterwards.

    The last row of a member gives its attributes, NULL included. Attributes not
    named, and all surrogate keys, stay as they are. Only new members are numbered.
    """
    contract = TABLES[table]
    key, natural = contract.surrogate, list(contract.natural)
    rows = _identified(rows, table)
    types = dict(contract.columns)
    last = last_wins(rows, natural, total_order(rows, order, natural)).select(
        *natural, *[F.col(a).cast(types[a]).alias(a) for a in attributes])
    before = target.select(*[F.col(c).alias(f"_{c}" if c in attributes else c) for c in contract.names])
    both = materialize(last.join(before, natural, "left"), f"{table}-offers")
    same = functools.reduce(
        lambda a, b: a & b, [F.col(a).eqNullSafe(F.col(f"_{a}")) for a in attributes])
    kept = both.filter(F.col(key).isNotNull() & ~same)
    fresh = both.filter(F.col(key).isNull()).drop(key)
    fresh = assign_keys(fresh, target, key, natural, table, top)
    return conform(kept, table).unionByName(conform(fresh, table))


def overwrite(
    rows: DataFrame, table: str, target: DataFrame, attributes: Sequence[str],
    order: Sequence[str] = (), top: int | None = None,
) -> DataFrame:
    """The whole dimension after adding members and replacing attributes."""
    changed = changed_members(rows, table, target, attributes, order, top)
    untouched = absent(target, changed, TABLES[table].natural)
    return conform(untouched, table).unionByName(changed)


def overwrite_members(
    rows: DataFrame, table: str, tables, attributes: Sequence[str], order: Sequence[str] = (),
) -> None:
    """Publish new attributes and members; nothing is published if nothing changes."""
    target = tables.read(table)
    changed = materialize(
        changed_members(rows, table, target, attributes, order, tables.top(table)), table)
    if not changed.isEmpty():
        untouched = absent(target, changed, TABLES[table].natural)
        tables.replace(table, conform(untouched, table).unionByName(changed))
    elif not tables.exists(table):
        tables.replace(table, changed)


def referring(fact: DataFrame, column: str, keys: Sequence[int]) -> DataFrame:
    """Keys of those given that rows of the fact refer to, one per row.

    The keys go into the scan, which leaves out the row groups and pages without any of them.
    """
    return fact.filter(F.col(column).isin(list(keys))).select(F.col(column).alias("_used"))


def blank_members(
    target: DataFrame, table: str, name: str, facts: Sequence[tuple[DataFrame, str]]
) -> DataFrame:
    """Blank or NULL members and whether a fact still refers to them.

    Up to ``FEW`` members are asked for by value; of more, the facts are joined with them.
    """
    surrogate = TABLES[table].surrogate
    blank = target.filter(~nonblank(F.col(name)))
    keys = [r[0] for r in blank.select(surrogate).limit(FEW + 1).collect()]
    used = None
    for fact, column in facts:
        if len(keys) <= FEW:
            hits = referring(fact, column, keys)
        else:
            side = blank.select(F.col(surrogate).alias("_used"))
            hits = side.join(fact.select(F.col(column).alias("_key")), F.col("_used") == F.col("_key"))
        hits = hits.select("_used").distinct()
        used = hits if used is None else used.unionByName(hits)
    if used is None:
        return blank.withColumn("referenced", F.lit(False))
    found = used.distinct().withColumnRenamed("_used", surrogate).withColumn("_hit", F.lit(True))
    return blank.join(found, surrogate, "left").select(
        *TABLES[table].names, F.col("_hit").isNotNull().alias("referenced")
    )


def purge(target: DataFrame, table: str, blanks: DataFrame) -> DataFrame:
    """The dimension without the blank members no fact refers to."""
    surrogate = TABLES[table].surrogate
    gone = blanks.filter(~F.col("referenced")).select(surrogate)
    return target.join(gone, surrogate, "left_anti").select(*TABLES[table].names)
