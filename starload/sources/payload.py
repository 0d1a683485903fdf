"""Records pushed as JSON documents, one document per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Each record is a variant of its own, so that a document may be larger than one can be.
SCHEMA = "records array<variant>, _corrupt_record string"


def _with_arrival(df: DataFrame) -> DataFrame:
    arrival = F.struct(
        F.col("_metadata.file_modification_time").alias("at"),
        F.col("_metadata.file_path").alias("path"),
    )
    return df.select(arrival.alias("arrival"), "records", "_corrupt_record")


def read_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in a folder as (arrival, records, _corrupt_record)."""
    reader = spark.read.schema(SCHEMA).option("multiLine", True)
    return _with_arrival(reader.json(folder))


def stream_payloads(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """The same documents as a stream of new files."""
    reader = spark.readStream.schema(SCHEMA).option("multiLine", True)
    return _with_arrival(reader.option("maxFilesPerTrigger", files_per_batch).json(folder))


def records(payloads: DataFrame) -> DataFrame:
    """One row per element of ``records``, with its place in the list.

    A document without the list, or with something else in its place, has none.
    A document that is not a JSON object gives one row, marked unreadable. ``records``
    is an array of variants, or one variant.
    """
    corrupt = F.lit(False)
    if "_corrupt_record" in payloads.columns:
        # An object whose ``records`` is no list is kept by the reader as it came.
        kind = F.schema_of_variant(F.try_parse_json("_corrupt_record"))
        corrupt = F.col("_corrupt_record").isNotNull() & ~F.coalesce(
            kind.startswith("OBJECT"), F.lit(False))
    elements = F.col("records")
    if payloads.schema["records"].dataType == T.VariantType():
        elements = F.try_variant_get(elements, "$", "array<variant>")
    listed = payloads.select(
        "arrival", corrupt.alias("unreadable"),
        F.posexplode_outer(elements).alias("position", "record"),
    )
    return listed.filter(F.col("unreadable") | F.col("position").isNotNull())
