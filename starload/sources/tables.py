"""Target tables of a session, held as plans without being published."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starload.operators.keys import assign_bucket_keys
from starload.operators.merge import absent, upsert
from starload.schemas import TABLES, conform, empty
from starload.session import materialize


class SessionTables:
    """Target tables as DataFrames; every change gives a new one. Batches of facts are copies."""

    by_member = False

    def __init__(self, spark: SparkSession, frames: dict[str, DataFrame] | None = None,
                 buckets: int = 8):
        self.spark = spark
        self.buckets = buckets
        self._frames = {name: conform(df, name) for name, df in (frames or {}).items()}

    def read(self, name: str) -> DataFrame:
        """The table, empty but with its columns when it does not exist yet."""
        if name not in self._frames:
            return empty(self.spark, name)
        return self._frames[name]

    def members(self, name: str, column: str, values: list | None) -> DataFrame:
        """The whole dimension: a plan in memory has no pages to leave out."""
        return self.read(name)

    def exists(self, name: str) -> bool:
        return name in self._frames

    def top(self, name: str) -> int | None:
        """Not recorded: keys go on from the highest one in use."""
        return None

    def create(self, *names: str) -> None:
        """The named tables without rows, where they do not exist."""
        for name in names:
            self._frames.setdefault(name, empty(self.spark, name))

    def append(self, name: str, rows: DataFrame) -> None:
        """Add rows that are known to be new."""
        rows = conform(rows, name)
        self._frames[name] = (
            self._frames[name].unionByName(rows) if name in self._frames else rows
        )

    def replace(self, name: str, df: DataFrame) -> None:
        """Put a whole new table in place."""
        self._frames[name] = conform(df, name)

    def upsert(self, name: str, batch: DataFrame) -> None:
        """Add or replace rows by natural key. They are not counted.

        The batch is written once: its keys and its rows are read by later plans, which would
        else each reduce all rows of the source again.
        """
        batch = materialize(conform(batch, name), f"batch-{name}")
        self._frames[name] = (
            upsert(self._frames[name], batch, TABLES[name].natural)
            if name in self._frames else batch
        )

    def insert_absent(self, name: str, batch: DataFrame) -> None:
        """Add rows whose natural key is not stored; stored rows stay as they are."""
        contract = TABLES[name]
        # Written once, as in ``upsert``.
        batch = materialize(conform(batch, name), f"batch-{name}")
        target = self.read(name)
        fresh = absent(batch, target, contract.natural)
        if contract.surrogate:
            fresh = assign_bucket_keys(
                fresh, target, contract.natural, contract.surrogate, self.buckets
            )
        self.append(name, fresh)
