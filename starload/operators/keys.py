"""Surrogate keys: stable, unique, and given without one task seeing all rows."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starload.session import materialize

# Facts are numbered in this many parts of a storage bucket at a time.
_PARTS = 16
# monotonically_increasing_id puts the partition number above the lower 33 bits.
_ROW_BITS = 33


def number_rows(df: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """Add ``_position``, the dense 0-based place of a row in ``order``.

    The rows are range-sorted and written once with their place inside their
    partition. Only the partition sizes, one number per partition, are summed up
    on the driver and sent back to the rows.
    """
    return number_groups(df, None, order, label)[0]


def number_groups(
    df: DataFrame, group: str | None, order: Sequence[str], label: str
) -> tuple[DataFrame, dict[str, int]]:
    """``number_rows`` by ``group`` and ``order``, and each group's first position."""
    order = [group, *order] if group else order
    placed = materialize(
        df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), label
    )
    placed = placed.select(
        *df.columns,
        F.shiftright("_at", _ROW_BITS).alias("_part"),
        F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row"),
    )
    # One row per partition, and one more for each group that starts inside one.
    named = F.col(group) if group else F.lit("")
    runs = (
        placed.groupBy("_part", named.alias("group"))
        .agg(F.count(F.lit(1)).alias("size")).orderBy("_part", "group").collect()
    )
    starts, firsts, end = {}, {}, 0
    for run in runs:
        starts.setdefault(run["_part"], end)
        firsts.setdefault(run["group"], end)
        end += run["size"]
    if len(starts) < 2:
        return placed.withColumn("_position", F.col("_row")).drop("_part", "_row"), firsts
    side = df.sparkSession.createDataFrame(
        pa.table({"_part": list(starts), "_start": list(starts.values())})
    )
    # One row per written partition, so the broadcast is bounded by their number.
    numbered = (
        placed.join(F.broadcast(side), "_part")
        .withColumn("_position", F.col("_start") + F.col("_row"))
        .drop("_part", "_row", "_start")
    )
    return numbered, firsts


def highest(target: DataFrame, key: str) -> int:
    """The highest key in use, 0 for an empty table."""
    return target.agg(F.max(key).alias("top")).first()["top"] or 0


def assign_keys(
    new: DataFrame, target: DataFrame, key: str, order: Sequence[str], label: str,
    top: int | None = None,
) -> DataFrame:
    """Keys above ``top``, or the target's highest one, in the order of the natural key."""
    top = highest(target, key) if top is None else top
    return (
        number_rows(new, order, label)
        .withColumn(key, F.lit(top + 1) + F.col("_position"))
        .drop("_position")
    )


def bucket(natural: Sequence[str], buckets: int) -> Column:
    """The bucket of a row: the hash by which a shuffle on the key places it.

    As long as the number of shuffle partitions is a multiple of ``buckets``, the
    output of a join or window on the key holds one bucket per partition and
    needs no further shuffle to be written by bucket.
    """
    return F.pmod(F.hash(*natural), F.lit(buckets))


def assign_bucket_keys(
    new: DataFrame, target: DataFrame, natural: Sequence[str], key: str, buckets: int
) -> DataFrame:
    """Unique keys for fact rows, each part of a bucket counting on its own.

    Of n parts, part p uses p+1, p+1+n, p+1+2*n, and so on. No total sort is
    needed, and only the buckets the batch touches have to be read.
    """
    n = buckets * _PARTS
    tops = (
        target.groupBy(bucket(natural, n).alias("_bucket")).agg(F.max(key).alias("_top"))
    )
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(*natural)) - 1
    used = F.coalesce(F.floor((F.col("_top") - 1 - F.col("_bucket")) / n) + 1, F.lit(0))
    # One row per part, so the broadcast is bounded by their number.
    return (
        new.withColumn("_bucket", bucket(natural, n))
        .withColumn("_place", place)
        .join(F.broadcast(tops), "_bucket", "left")
        .withColumn(key, (F.col("_bucket") + 1 + (used + F.col("_place")) * n).cast("long"))
        .drop("_bucket", "_place", "_top")
    )
