import random
from decimal import Decimal

from helpers import INVENTORY, INVOICES, VENDORS, at, frame, invoice, rows
from pyspark.sql import functions as F
from starload.plans import inventory, payload, payments
from starload.plans.run import run
from starload.sources.payload import read_payloads
from starload.sources.warehouse import Warehouse
from starload.streaming.loads import follow_invoices, load_new_invoices, push_requests
from test_jobs import record

PUSHED = ("d_date", "d_item", "d_project", "f_inventory_requests")


def drop(folder, name, *records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text('{"records": [' + ", ".join(records) + "]}")


def test_pushed_requests_equal_the_batch(spark, tmp_path):
    source = tmp_path / "in"
    stream = Warehouse(spark, str(tmp_path / "stream"), buckets=4)

    def follow():
        push_requests(spark, str(source), stream, str(tmp_path / "cp")).awaitTermination()

    drop(source, "a.json", record("1", "axe"), record("2", "bolt"), record("1", "axe", '"7"'))
    drop(source, "b.json", record("3", "bolt", "0"), "5")
    (source / "c.json").write_text("not json")
    follow()
    drop(source, "d.json", record("2", "cog", "9"), record("4", "cog"))
    follow()
    batch = Warehouse(spark, str(tmp_path / "batch"), buckets=4)
    payload.load(read_payloads(spark, str(source)), batch)
    for name in PUSHED:
        assert rows(stream.read(name)) == rows(batch.read(name))
    assert rows(stream.read("f_inventory_requests"), "request_id", "quantity") == [
        ("1", 7.0), ("2", 9.0), ("4", 5.0)]
    follow()
    assert stream.read("f_inventory_requests").count() == 3


def test_invoice_stream_equals_the_batch(spark, tmp_path):
    folder = str(tmp_path / "invoices")
    vendors = [frame(spark, VENDORS, ("v1", "ACME"))]
    stream = Warehouse(spark, str(tmp_path / "stream"), buckets=4)

    def arrive(*records):
        frame(spark, INVOICES, *records).coalesce(1).write.mode("append").parquet(folder)
        follow_invoices(spark, folder, lambda: vendors[-1], stream, str(tmp_path / "cp"),
                        every=None).awaitTermination()

    def stored(tables):
        named = (
            tables.read("f_payments").join(tables.read("d_vendor"), "vendor_key")
            .join(tables.read("d_invoice"), "invoice_key")
        )
        return rows(named, "vendor_id", "vendor_name", "invoice_id", "date_key", "amount_to_pay")

    arrive(invoice("i1", "Acme Steel", "2024-01-01", 1), invoice("i2", "Best Pipe", "2024-01-01", 2))
    assert len(stored(stream)) == 1
    # A vendor added later also meets the invoices loaded before.
    vendors.append(frame(spark, VENDORS, ("v1", "ACME"), ("v2", "pipe")))
    arrive(invoice("i1", "Acme Steel", "2024-01-01", 50), invoice("i3", "acme pipe", "2024-01-02", 3))
    batch = Warehouse(spark, str(tmp_path / "batch"), buckets=4)
    payments.load(spark.read.parquet(folder), vendors[-1], batch)
    assert stored(stream) == stored(batch) == [
        ("v1", "ACME", "i1", 20240101, 1.0), ("v1", "ACME", "i3", 20240102, 3.0),
        ("v2", "pipe", "i2", 20240101, 2.0), ("v2", "pipe", "i3", 20240102, 3.0)]


def test_a_vendor_name_that_comes_back_meets_what_it_missed(spark, tmp_path):
    rng = random.Random(4)
    for turn in range(2):
        folder = str(tmp_path / f"invoices{turn}")
        stream = Warehouse(spark, str(tmp_path / f"stream{turn}"), buckets=2)
        names = ["acme", "zenith", "acme"] if turn == 0 else rng.choices(["acme", "zenith", "pipe"], k=4)
        for i, name in enumerate(names):
            new = [invoice(f"i{i}{s}", f"{s} works", "2024-01-01", i + 1) for s in ("acme", "pipe")]
            frame(spark, INVOICES, *new).coalesce(1).write.mode("append").parquet(folder)
            vendors = frame(spark, VENDORS, ("v1", name))
            follow_invoices(spark, folder, lambda v=vendors: v, stream, str(tmp_path / f"cp{turn}"),
                            every=None).awaitTermination()
        # Payments are never taken back, so the stream holds those of every name it had.
        every = spark.read.parquet(folder)
        stored = stream.read("f_payments").join(stream.read("d_invoice"), "invoice_key")
        want = set()
        for i, name in enumerate(names):
            want |= {r[0] for r in every.filter(f"supplier_name LIKE '%{name}%'").select(
                "avenue_created_invoice_id").collect() if int(r[0][1]) <= max(
                    k for k, n in enumerate(names) if n == name)}
        assert {r[0] for r in stored.select("invoice_id").collect()} == want


def test_a_new_vendor_reads_the_files_it_can_match(spark, tmp_path):
    """Of many files only those the index names are read, and the stream equals the batch."""
    folder = str(tmp_path / "invoices")
    suppliers = ["Acme Steel", "Best Pipe", "a_c", "%", "North Wood", "North Wind", "", "\\x", None]
    for i, name in enumerate(suppliers):
        frame(spark, INVOICES, invoice(f"i{i}", name, "2024-01-01", i)).coalesce(1).write.mode(
            "append").parquet(folder)

    def read(*files):
        return spark.read.parquet(*(files or [folder])).withColumn("_file", F.col("_metadata.file_path"))

    warehouse = Warehouse(spark, str(tmp_path / "w"), buckets=16)
    first = frame(spark, VENDORS, ("v1", "acme"))
    load_new_invoices(read(), read, first, warehouse, "b0")
    second = frame(spark, VENDORS, ("v1", "acme"), ("v2", "wood"), ("v3", "xabcx"))
    none = read().limit(0)
    found = load_new_invoices(none, read, second, warehouse, "b1")
    names = {r[0] for r in read(*found).select("supplier_name").collect()}
    # "%" and "" match every vendor as patterns; "a_c" is led by one character.
    assert {"North Wood", "%", "", "a_c"} <= names and not names & {"Acme Steel", "Best Pipe", "North Wind"}
    holds = warehouse.read_near("supplier_holds", frame(spark, "gram string", ("wood",)))
    assert len(holds.inputFiles()) < len(warehouse.read("supplier_holds").inputFiles())
    batch = Warehouse(spark, str(tmp_path / "batch"), buckets=4)
    payments.load(read(), second, batch)

    def stored(tables):
        return rows(tables.read("f_payments").join(tables.read("d_vendor"), "vendor_key").join(
            tables.read("d_invoice"), "invoice_key"), "vendor_id", "invoice_id", "date_key")

    assert stored(warehouse) == stored(batch)
    # A vendor of wildcards only meets all; a repeated batch changes nothing.
    third = frame(spark, VENDORS, ("v4", "%"))
    assert len(load_new_invoices(none, read, third, warehouse, "b2")) == len(suppliers) - 1
    before = stored(warehouse)
    load_new_invoices(read(), read, third, warehouse, "b2")
    assert stored(warehouse) == before
    for name in ("supplier_holds", "supplier_leads", "supplier_files"):
        assert warehouse.read(name).count() == warehouse.read(name).distinct().count()


def test_a_stream_without_an_index_gets_one(spark, tmp_path):
    folder = str(tmp_path / "invoices")
    frame(spark, INVOICES, invoice("i1", "Acme Steel", "2024-01-01", 1)).write.parquet(folder)
    warehouse = Warehouse(spark, str(tmp_path / "w"), buckets=2)
    warehouse.replace("vendors_seen", frame(spark, VENDORS, ("v1", "other")))
    frame(spark, INVOICES, invoice("i2", "Pipe Works", "2024-01-01", 1)).write.mode("append").parquet(folder)
    follow_invoices(spark, folder, lambda: frame(spark, VENDORS, ("v2", "acme")), warehouse,
                    str(tmp_path / "cp"), every=None).awaitTermination()
    assert warehouse.read("f_payments").count() == 1 and warehouse.read("supplier_files").count() == 2


def test_rejects_are_kept_once_per_run(spark, tmp_path):
    """One batch run three times leaves its rejects once, whatever ran between."""
    warehouse = Warehouse(spark, str(tmp_path / "w"), buckets=2)

    def bad(number):
        return frame(spark, INVENTORY, (number, None, Decimal(1), "here", at("2024-01-01 00:00:00")))

    def kept():
        return rows(warehouse.read("rejects"), "run_id", "key")

    for _ in range(3):
        counts = run(inventory.load, warehouse, bad("1"), run_id="a")
    assert kept() == [("a", "1")] and counts["retrieved"] == 1
    for i in range(9):
        run(inventory.load, warehouse, bad(str(i)), run_id=f"r{i:02}")
    run(inventory.load, warehouse, bad("1"))
    assert len(kept()) == 11
    # Old runs are put together, and still replaced or taken back as one.
    run(inventory.load, warehouse, bad("2"), run_id="a")
    assert [k for k in kept() if k[0] == "a"] == [("a", "2")] and len(kept()) == 11
    good = frame(spark, INVENTORY, ("9", "axe", Decimal(1), "here", at("2024-01-01 00:00:00")))
    run(inventory.load, warehouse, good, run_id="a")
    assert not [k for k in kept() if k[0] == "a"] and len(kept()) == 10
    assert rows(warehouse.read("run_counts").filter("run_id = 'a'"), "outcome", "n_rows") == [("loaded", 1)]
    assert warehouse.read("run_counts").select("run_id").distinct().count() == 10


def test_a_stream_restarted_after_a_failure_repeats_no_reject(spark, tmp_path):
    source = tmp_path / "in"
    warehouse = Warehouse(spark, str(tmp_path / "w"), buckets=2)
    drop(source, "a.json", record("1", "axe"), record("2", "axe", "0"))

    def follow():
        push_requests(spark, str(source), warehouse, str(tmp_path / "cp")).awaitTermination()

    follow()
    # As after a failure behind the load: the batch was not yet marked as done.
    for log in (tmp_path / "cp" / "commits").iterdir():
        log.unlink()
    follow()
    assert rows(warehouse.read("rejects"), "key", "reason") == [("2", "incomplete")]
    assert warehouse.read("f_inventory_requests").count() == 1
