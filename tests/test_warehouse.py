import pytest
from pyspark.sql import functions as F

from helpers import (
    EMPLOYEES, INVENTORY, INVOICES, PAYMENTS, REQUESTS, VENDORS, at, frame, invoice, members,
    rows, session_tables, worker_payment,
)
from starload.operators import dims, keys
from starload.operators.checks import ConstraintViolation
from starload.operators.lookup import UnknownMember
from starload.operators.merge import Conflict
from starload.plans import inventory, payments, requests, worker_payments
from starload.plans.run import run
from starload.sources.warehouse import Warehouse, merge_catalog_table
from test_jobs import Q, REQUEST_MEMBERS, known_days, request


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"), buckets=4)


def stock(spark, numbers, item="nail", quantity=1, when="2024-01-02"):
    return frame(spark, INVENTORY, *[(str(n), item, Q(quantity), "north", at(when))
                                     for n in numbers])


def snapshot(tables, *names):
    return {n: rows(tables.read(n)) for n in names}


STOCK = ("d_date", "d_item", "d_project", "f_inventory")


def test_same_tables_as_in_a_session(spark, warehouse):
    session = session_tables(spark)
    for batch in (stock(spark, range(20)), stock(spark, range(10, 30), "bolt", 2, "2024-01-03")):
        inventory.load(batch, warehouse)
        inventory.load(batch, session)
    assert snapshot(warehouse, *STOCK) == snapshot(session, *STOCK)


def test_second_load_changes_nothing(spark, warehouse):
    batch = stock(spark, range(20))
    inventory.load(batch, warehouse)
    before = snapshot(warehouse, *STOCK)
    inventory.load(batch, warehouse)
    assert snapshot(warehouse, *STOCK) == before


def test_upsert_rewrites_only_touched_buckets(spark, warehouse):
    inventory.load(stock(spark, range(40)), warehouse)
    before = warehouse._pointer("f_inventory")["parts"]
    assert len(before) == 4
    inventory.load(stock(spark, [7], quantity=9), warehouse)
    after = warehouse._pointer("f_inventory")["parts"]
    assert sum(before[b] != after[b] for b in before) == 1
    warehouse.vacuum("f_inventory")
    assert warehouse.read("f_inventory").count() == 40
    assert rows(warehouse.read("f_inventory").filter("inventory_id = '7'"), "quantity") == [(9.0,)]


def test_failed_load_leaves_the_table(spark, warehouse, monkeypatch):
    inventory.load(stock(spark, range(20)), warehouse)
    before = snapshot(warehouse, "f_inventory")

    def fail(*_):
        raise OSError("lost")

    monkeypatch.setattr(warehouse, "_switch", fail)
    with pytest.raises(OSError):
        warehouse.upsert("f_inventory", warehouse.read("f_inventory").withColumn(
            "quantity", F.lit(5)))
    monkeypatch.undo()
    assert snapshot(warehouse, "f_inventory") == before
    inventory.load(stock(spark, range(20), quantity=3), warehouse)
    assert rows(warehouse.read("f_inventory").select("quantity").distinct()) == [(3.0,)]


def test_second_writer_is_refused(spark, warehouse):
    inventory.load(stock(spark, range(3)), warehouse)
    old = warehouse._pointer("d_item")
    inventory.load(stock(spark, range(3), "bolt"), warehouse)
    with pytest.raises(Conflict, match="another writer"):
        warehouse._switch("d_item", old, old["parts"])


def test_keys_made_from_an_old_read_are_refused(spark, warehouse):
    other = Warehouse(spark, warehouse.root, buckets=4)
    inventory.load(stock(spark, range(3)), warehouse)
    load = warehouse.begin()
    stale = keys.assign_keys(frame(spark, "item_name string", ("cog",)),
                             load.read("d_item"), "item_key", ["item_name"], "test")
    inventory.load(stock(spark, range(3), "bolt"), other)
    with pytest.raises(Conflict):
        load.append("d_item", stale)
    assert rows(warehouse.read("d_item")) == [(1, "nail"), (2, "bolt")]


def test_loads_that_share_a_warehouse_do_not_share_their_reads(spark, warehouse):
    """Load a reads, load b publishes and reads, load a publishes what it made of its old read."""
    run(inventory.load, warehouse, stock(spark, range(2)))
    a, b = warehouse.begin(), warehouse.begin()

    def offer(load, *items):
        values = {("d_item", "item_name"): F.col("item_name")}
        offered = dims.offers(frame(spark, "item_name string", *[(i,) for i in items]), values)
        new = dims.new_members(offered, values, {"d_item": load.read("d_item")},
                               {"d_item": load.top("d_item")})
        return new["d_item"]

    of_a = offer(a, "axe", "bolt")
    b.append("d_item", offer(b, "axe", "cog"))
    b.read("d_item"), warehouse.read("d_item"), a.read("d_item")
    with pytest.raises(Conflict):
        a.append("d_item", of_a)
    again = warehouse.begin()
    again.append("d_item", offer(again, "axe", "bolt"))
    assert rows(warehouse.read("d_item")) == [(1, "nail"), (2, "axe"), (3, "cog"), (4, "bolt")]


def test_members_are_checked(spark, warehouse):
    load = warehouse.begin()
    for members, problem in (
        ([(1, "v" * 21, "n")], "vendor_id too long"), ([(1, "v", "n" * 256)], "vendor_name too long"),
        ([(1, "v", "n"), (2, "v", "m")], "repeated vendor_id"),
        ([(1, "v", "n"), (1, "w", "m")], "repeated vendor_key"),
    ):
        df = frame(spark, "vendor_key long, vendor_id string, vendor_name string", *members)
        with pytest.raises(ConstraintViolation, match=problem):
            load.append("d_vendor", df)
        with pytest.raises(ConstraintViolation, match=problem):
            load.replace("d_vendor", df)
    assert not warehouse.exists("d_vendor")


def test_a_purged_key_is_not_given_again(spark, warehouse):
    run(inventory.load, warehouse, stock(spark, [1], "nail"))
    run(inventory.load, warehouse, stock(spark, [2], "axe"))
    warehouse.replace("d_item", warehouse.read("d_item").filter("item_name <> 'axe'"))
    run(inventory.load, warehouse, stock(spark, [3], "cog"))
    assert rows(warehouse.read("d_item")) == [(1, "nail"), (3, "cog")]


def test_small_batches_leave_few_files(spark, tmp_path):
    small = Warehouse(spark, str(tmp_path / "small"), buckets=1)
    df = "payment_key long, vendor_key long, invoice_key long, date_key int"
    small.check = False
    for i in range(24):
        small.insert_absent("f_payments", frame(spark, df, (None, i, i, i)))
        small.append("d_item", frame(spark, "item_key long, item_name string", (i + 1, f"item {i}")))
    for name in ("f_payments", "d_item"):
        assert small.read(name).count() == 24
        pointer = small._pointer(name)
        assert all(len(paths) <= 8 for paths in pointer["parts"].values())
        assert len(small._numbers(name)) <= 9
    assert small.read("f_payments").select("payment_key").distinct().count() == 24


def test_unchanged_attributes_publish_nothing(spark, warehouse):
    warehouse.replace("core_dim_date", known_days(spark, "2024-01-01"))
    batch = frame(spark, PAYMENTS, worker_payment("p1", "w1", "W", "due", "u@x", "2024-01-01"))
    run(worker_payments.load, warehouse, batch)
    number = warehouse._pointer("core_dim_worker")["number"]
    run(worker_payments.load, warehouse, batch)
    assert warehouse._pointer("core_dim_worker")["number"] == number


def test_run_repeats_a_load_that_met_another_writer(spark, warehouse, monkeypatch):
    inventory.load(stock(spark, range(3)), warehouse)
    other = Warehouse(spark, warehouse.root, buckets=4)
    append, met = Warehouse.append, []

    def late(self, name, df):
        if name == "d_item" and not met:
            met.append(True)
            inventory.load(stock(spark, [8], "bolt"), other)
        append(self, name, df)

    monkeypatch.setattr(Warehouse, "append", late)
    run(inventory.load, warehouse, stock(spark, [9], "axe"))
    assert met
    assert rows(warehouse.read("d_item")) == [(1, "nail"), (2, "bolt"), (3, "axe")]
    assert rows(warehouse.read("f_inventory"), "inventory_id", "item_key") == [
        ("0", 1), ("1", 1), ("2", 1), ("8", 2), ("9", 3)]


def test_broken_batches_are_refused(spark, warehouse):
    inventory.load(stock(spark, range(3)), warehouse)
    fact = warehouse.read("f_inventory")
    with pytest.raises(ConstraintViolation, match="repeated inventory_id"):
        warehouse.upsert("f_inventory", fact.unionByName(fact))
    with pytest.raises(ConstraintViolation, match="item_key without a row in d_item"):
        warehouse.upsert("f_inventory", fact.withColumn("item_key", F.lit(99)))


def test_split_batch_gives_the_same_facts(spark, tmp_path):
    whole = stock(spark, range(30)).unionByName(
        stock(spark, range(20, 50), "bolt", 2, "2024-01-03"))
    one = Warehouse(spark, str(tmp_path / "one"), buckets=4)
    inventory.load(whole, one)
    two = Warehouse(spark, str(tmp_path / "two"), buckets=4)
    inventory.load(whole.filter("updated_date < '2024-01-03'"), two)
    inventory.load(whole.filter("updated_date >= '2024-01-03'"), two)
    shown = ("inventory_id", "item_name", "quantity")
    assert rows(one.read("f_inventory").join(one.read("d_item"), "item_key"), *shown) == rows(
        two.read("f_inventory").join(two.read("d_item"), "item_key"), *shown)


def test_requests_and_compaction(spark, warehouse):
    for name, (schema, records) in REQUEST_MEMBERS.items():
        warehouse.replace(name, frame(spark, schema, *records))
    staff = frame(spark, EMPLOYEES, ("e1", "A", "B", "a@x"))
    for start in (0, 5, 10):
        batch = frame(spark, REQUESTS, *[request(str(n), quantity=start)
                                         for n in range(start, start + 8)])
        requests.load(staff, batch, warehouse)
    fact = rows(warehouse.read("fact_inventory_requests"))
    assert len(fact) == 18 and len({r[0] for r in fact}) == 18
    assert rows(warehouse.read("fact_inventory_requests").filter("request_id = '6'"),
                "quantity") == [(0.0,)]
    warehouse.compact("fact_inventory_requests")
    assert rows(warehouse.read("fact_inventory_requests")) == fact
    parts = warehouse._pointer("fact_inventory_requests")["parts"]
    assert all(len(paths) == 1 for paths in parts.values())
    requests.load(staff, frame(spark, REQUESTS, request("99")), warehouse)
    assert warehouse.read("fact_inventory_requests").select("request_key").distinct().count() == 19
    warehouse.append("d_item", frame(spark, "item_key long, item_name string", (2, ""), (3, " ")))
    inventory.load(stock(spark, [1], item=""), warehouse)
    again = run(requests.load, warehouse, staff, frame(spark, REQUESTS, request("99")))
    assert again == {"retrieved": 1, "loaded": 1, "merged": 0,
                     "blank members kept in d_item": 1}
    assert members(warehouse, "d_item") == [("",), ("nail",)]
    warehouse.compact("d_request_status")
    assert members(warehouse, "d_request_status") == [("open",)]


def test_payments_are_stored_once(spark, warehouse):
    vendors = frame(spark, VENDORS, ("v1", "ACME"))
    batch = frame(spark, INVOICES, invoice("i1", "acme steel", "2024-01-01", 1),
                  invoice("i2", "acme", "2024-01-01", 2))
    for _ in range(2):
        payments.load(batch, vendors, warehouse)
    assert rows(warehouse.read("f_payments"), "amount_to_pay") == [(1.0,), (2.0,)]


def test_strict_load_writes_nothing(spark, warehouse):
    warehouse.replace("core_dim_date", known_days(spark, "2024-04-01"))
    good = worker_payment("1", "w1", "A", "due", "u", "2024-04-01")
    with pytest.raises(UnknownMember):
        worker_payments.load(frame(spark, PAYMENTS, good, worker_payment(
            "2", "w1", "A", "due", "u", "2024-05-01")), warehouse)
    assert not any(map(warehouse.exists, ("core_dim_worker", "fact_worker_payments")))
    worker_payments.load(frame(spark, PAYMENTS, good), warehouse)
    assert warehouse.read("fact_worker_payments").count() == 1


def test_run_counts_and_keeps_rejects(spark, warehouse, tmp_path, monkeypatch):
    areas = []
    monkeypatch.setattr("starload.session.scratch_root", lambda _: areas.append(1) or str(
        tmp_path / "scratch"))
    warehouse.create("f_inventory", "d_item")
    assert warehouse.read("f_inventory").count() == 0 and warehouse.exists("d_item")
    batch = stock(spark, range(4)).unionByName(stock(spark, [1, 2], item=None))
    assert run(inventory.load, warehouse, batch) == {
        "retrieved": 6, "loaded": 4, "missing item_name": 2, "merged": 4}
    assert rows(warehouse.read("rejects"), "job", "key", "reason") == [
        ("inventory", "1", "missing item_name"), ("inventory", "2", "missing item_name")]
    assert areas and not list((tmp_path / "scratch" / "starload").iterdir())
    vendors = frame(spark, VENDORS, ("v1", "ACME"))
    invoices = frame(spark, INVOICES, *[invoice("i1", "acme", "2024-01-01", n) for n in (1, 2)])
    assert run(payments.load, warehouse, invoices, vendors) == {
        "retrieved": 2, "loaded": 2, "merged": 1}
    assert run(payments.load, warehouse, invoices, vendors)["merged"] == 0


def test_replaced_fact_is_still_found_by_key(spark, warehouse):
    inventory.load(stock(spark, range(6)), warehouse)
    warehouse.replace("f_inventory", warehouse.read("f_inventory").filter("inventory_id < 3"))
    inventory.load(stock(spark, [1], quantity=8), warehouse)
    assert rows(warehouse.read("f_inventory"), "inventory_id", "quantity") == [
        ("0", 1.0), ("1", 8.0), ("2", 1.0)]


def test_catalog_merge_needs_row_level_operations(spark):
    """The merge resolves; a plain view then refuses it."""
    frame(spark, "id long, v string", (1, "a")).createOrReplaceTempView("plain_target")
    with pytest.raises(Exception, match="(?i)merge into|not support"):
        merge_catalog_table(frame(spark, "id long, v string", (1, "b")), "plain_target", ["id"])
