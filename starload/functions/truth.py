"""Truth of loosely typed values pushed as JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def truthy(value: Column, kind: Column | None = None, text: Column | None = None) -> Column:
    """Whether a variant holds a value: NULL, '', false, 0, [] and {} do not.

    The decision needs the variant, since the number 0 is empty but the text
    "0" is not. ``kind`` and ``text`` are its schema and its text, where they
    are columns already.
    """
    kind = F.schema_of_variant(value) if kind is None else kind
    text = F.try_variant_get(value, "$", "string") if text is None else text
    is_number = kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    zero = F.try_variant_get(value, "$", "double") == 0
    # The text of a list or an object is its JSON.
    empty = (
        F.when(kind == "STRING", text == "").when(is_number, zero)
        .otherwise((kind == "VOID") | text.isin("false", "[]", "{}"))
    )
    return kind.isNotNull() & ~F.coalesce(empty, F.lit(False))


def is_scalar(value: Column, kind: Column | None = None) -> Column:
    """True for a text, number or boolean; false for lists and objects."""
    kind = F.schema_of_variant(value) if kind is None else kind
    return ~kind.rlike("^(ARRAY|OBJECT|VOID)")
