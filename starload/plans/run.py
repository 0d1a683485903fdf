"""Running a load against published tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.operators.merge import Conflict
from starload.plans.report import Report
from starload.session import configure, scratch
from starload.sources.warehouse import Warehouse


def run(
    load: Callable[..., Report], warehouse: Warehouse, *sources: DataFrame, attempts: int = 3,
    run_id: str | None = None,
) -> dict[str, int]:
    """Load, keep the rejected rows and return the counts of the run.

    Rejected rows are kept by run. A run that is repeated under its ``run_id``, as a stream
    does with a batch after a failure, leaves those of its last time only, and none if there
    are none any more; the counts of a run with an id are kept as well.

    "loaded" counts the source rows that passed every check, "merged" the fact
    rows they added or replaced; the rest are the reasons of rejection. A load
    that met another writer of one of its tables is run again.
    """
    spark = configure(warehouse.spark)
    with scratch(spark):
        for left in reversed(range(attempts)):
            try:
                report = load(*sources, warehouse.begin())
                break
            except Conflict:
                if not left:
                    raise
        # One row per outcome reaches the driver; rejects are read only if there are any.
        counts = {r["outcome"]: r["n_rows"] for r in report.counters().collect()}
        loaded = counts.pop("loaded", 0)
        named = run_id or uuid.uuid4().hex
        now = F.current_timestamp()
        if counts or run_id:
            warehouse.put_run(
                "rejects", named, report.rejects().withColumn("loaded_at", now) if counts else None)
        if run_id:
            outcomes = [(report.job, k, n) for k, n in {"loaded": loaded, **counts}.items()]
            warehouse.put_run("run_counts", run_id, spark.createDataFrame(
                outcomes, "job string, outcome string, n_rows long").withColumn("loaded_at", now))
        held = {
            f"blank members kept in {name}": found.filter("referenced").count()
            for name, found in report.blanks.items()
        }
    retrieved = loaded + sum(counts.values())
    return {"retrieved": retrieved, "loaded": loaded, **counts, "merged": report.merged, **held}
