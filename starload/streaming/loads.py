"""New files drive the same loads as in batch; both are safe to replay.

The target tables are the only state. A micro-batch that is run again after a failure finds
its rows merged already and changes nothing: facts and members by their keys, rejected rows and
counts by the number of the batch, which the checkpoint keeps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from starload.operators import fuzzy
from starload.operators.merge import absent
from starload.plans import payload, payments
from starload.plans.run import run
from starload.session import materialize, scratch
from starload.sources.payload import stream_payloads
from starload.sources.warehouse import Warehouse


def _start(writer: DataStreamWriter, checkpoint: str, every: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def push_requests(
    spark: SparkSession, folder: str, warehouse: Warehouse, checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Upsert requests from payload files as they arrive.

    Without ``every`` the files present are loaded and the query ends.
    """

    def load(batch: DataFrame, number: int) -> None:
        run(payload.load, warehouse, batch, run_id=f"{checkpoint}#{number}")

    return _start(stream_payloads(spark, folder).writeStream.foreachBatch(load), checkpoint, every)


def index_invoices(invoices: DataFrame, warehouse: Warehouse) -> None:
    """Add the supplier names of new invoices, and the files they came in, to the index.

    Names are taken apart once: those with a file already are not read again. What a batch
    adds twice after a failure is there once.
    """
    rows = payments.readable(invoices, "_file").select(
        F.lower("supplier_name").alias("name"), F.col("_file").alias("file")).distinct()
    rows = materialize(rows, "supplier-files")
    names = materialize(rows.select("name").distinct(), "supplier-names")
    new = materialize(absent(names, warehouse.read_near("supplier_files", names), ["name"]), "new-names")
    # Files come last: a name that has one is known to be indexed.
    if not new.isEmpty():
        warehouse.insert_absent("supplier_holds", fuzzy.held_stretches(new))
        warehouse.insert_absent("supplier_leads", fuzzy.pattern_stretch(new))
    warehouse.insert_absent("supplier_files", rows)


def files_near(vendors: DataFrame, warehouse: Warehouse) -> list[str]:
    """The files that may hold an invoice matching a vendor's name, by the index.

    A name holds the stretch a vendor's name asks for, or asks for one that the vendor's name
    holds. Only the buckets of these stretches and then of the names found are read.
    """
    names = materialize(fuzzy.distinct_names(vendors, "vendor_name"), "vendor-names")
    asked = materialize(fuzzy.pattern_stretch(names).select("gram").distinct(), "asked")
    if asked.filter("gram = ''").isEmpty():
        found = warehouse.read_near("supplier_holds", asked).join(asked, "gram", "left_semi").select("name")
        # Names of wildcards only ask for the empty stretch.
        held = fuzzy.held_stretches(names).select("gram").unionByName(asked.select(F.lit("").alias("gram")))
        held = materialize(held.distinct(), "held")
        found = found.unionByName(
            warehouse.read_near("supplier_leads", held).join(held, "gram", "left_semi").select("name"))
        found = materialize(found.distinct(), "names-found")
        files = warehouse.read_near("supplier_files", found).join(found, "name", "left_semi")
    else:
        files = warehouse.read("supplier_files")
    # As many rows as files to be read, which the driver lists in any case.
    return sorted(r["file"] for r in files.select("file").distinct().collect())


def load_new_invoices(
    batch: DataFrame, read: Callable[..., DataFrame], vendors: DataFrame, warehouse: Warehouse,
    run_id: str | None = None,
) -> list[str]:
    """Match new invoices to the known vendors, and new vendors to the invoices they may match.

    A full re-read would also match a vendor that is new or has a new name to the invoices
    loaded before. Such vendors meet them through an index of the supplier names (see
    ``files_near``); "known" are the names of the batch before, not all names ever held.
    ``batch`` has the file of each invoice as ``_file``, and ``read`` reads invoices with it from
    some files, or all. Returns the files read for new vendors.
    """
    key = ["vendor_id", "vendor_name"]
    vendors = vendors.select(*key).distinct()
    seen = warehouse.read("vendors_seen")
    files = []
    with scratch(warehouse.spark):
        # A stream begun before there was an index has its first invoices only in the files.
        begun = warehouse.exists("vendors_seen") and not warehouse.exists("supplier_files")
        index_invoices(read() if begun else batch, warehouse)
        vendors = materialize(vendors, "vendors")
        unseen = materialize(absent(vendors, seen, key), "new-vendors")
        ids = [run_id and f"{run_id}/{part}" for part in ("known vendors", "new vendors")]
        run(payments.load, warehouse, batch, vendors.join(seen, key, "left_semi"), run_id=ids[0])
        if not unseen.isEmpty():
            files = files_near(unseen, warehouse)
            if files:
                run(payments.load, warehouse, read(*files), unseen, run_id=ids[1])
        # A name that is gone must count as new when it comes back.
        if not unseen.isEmpty() or not absent(seen, vendors, key).isEmpty():
            warehouse.replace("vendors_seen", vendors)
    return files


def follow_invoices(
    spark: SparkSession, folder: str, read_vendors: Callable[[], DataFrame],
    warehouse: Warehouse, checkpoint: str, every: str | None = "5 minutes",
) -> StreamingQuery:
    """Insert payments for new invoice files in a Parquet folder."""
    schema = spark.read.parquet(folder).schema
    located = [*schema.names, F.col("_metadata.file_path").alias("_file")]

    def read(*files: str) -> DataFrame:
        return spark.read.schema(schema).parquet(*(files or [folder])).select(*located)

    def load(batch: DataFrame, number: int) -> None:
        load_new_invoices(batch, read, read_vendors(), warehouse, f"{checkpoint}#{number}")

    stream = spark.readStream.schema(schema).parquet(folder).select(*located)
    return _start(stream.writeStream.foreachBatch(load), checkpoint, every)
