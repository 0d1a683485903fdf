"""What a load leaves behind besides its tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from starload.operators import clean


@dataclass(frozen=True)
class Report:
    """Every source row with the reason it was rejected for, if any.

    ``merged`` is the number of fact rows that were added or replaced, where the
    tables were published.
    ``blanks`` are the blank members a purge found, by dimension, with whether a
    fact still refers to them; those were kept.
    """

    job: str
    key: str
    outcome: DataFrame
    merged: int | None = None
    blanks: dict[str, DataFrame] = field(default_factory=dict)

    def rejects(self) -> DataFrame:
        """Rejected rows as (job, key, reason)."""
        return clean.rejects(self.outcome, self.job, self.key)

    def counters(self) -> DataFrame:
        """Rows per outcome."""
        return clean.counters(self.outcome)
