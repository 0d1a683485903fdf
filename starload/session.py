"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


# Rows of a batch that is small enough to ask dimensions for its members by value.
FEW = 500

_AREA: ContextVar[str | None] = ContextVar("scratch area", default=None)


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings every load relies on.

    Dates are cut in UTC. Adaptive execution coalesces small partitions and
    splits the hot ones of a shuffled join, also where that costs one more
    shuffle afterwards. File sizes are counted fourfold, since the broadcast
    threshold is about data in memory and files are compressed. Of a field that
    comes twice in a JSON object the last one counts.
    """
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    spark.conf.set("spark.sql.sources.fileCompressionFactor", "4.0")
    # A few members are looked up by value in the files of a dimension, not by their range.
    spark.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", str(FEW))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="starload-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def _file_system(spark: SparkSession, folder: str):
    """A folder as a Hadoop path, and the file system it is on."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def session_area(spark: SparkSession) -> str:
    """Where copies go outside of ``scratch``; dropped when the application ends."""
    area = f"{scratch_root(spark)}/starload/{spark.sparkContext.applicationId}"
    path, files = _file_system(spark, area)
    files.mkdirs(path)
    files.deleteOnExit(path)
    return area


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Keep the copies made inside the block together and drop them at its end."""
    area = f"{scratch_root(spark)}/starload/{uuid.uuid4().hex}"
    token = _AREA.set(area)
    try:
        yield area
    finally:
        _AREA.reset(token)
        path, files = _file_system(spark, area)
        files.delete(path, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a result feeds several outputs or holds values that must not be
    computed twice. Unlike a checkpoint the copy is columnar: later readers
    prune columns, and its file size tells the optimizer whether it may be
    broadcast.
    """
    spark = df.sparkSession
    area = _AREA.get() or session_area(spark)
    path = f"{area}/{label}-{uuid.uuid4().hex}"
    # Copies are written and read once or twice: their size counts more than the time to pack them.
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
