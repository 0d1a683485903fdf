"""Physical plans: what must not be shuffled, collected or compared pairwise."""

import re

import pytest
from pyspark.sql import functions as F

from helpers import frame
from starload.operators import dims, keys, lookup, merge
from starload.plans import inventory, payments, requests
from starload.session import materialize
from starload.sources.scan import scan
from starload.sources.tables import SessionTables
from starload.sources.warehouse import Warehouse
from testbed.queries import QUERIES
from testbed.sources import source

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def settings(spark):
    """Change settings for one test."""
    saved = {}

    def change(**pairs):
        for name, value in pairs.items():
            key = name.replace("__", ".")
            saved.setdefault(key, spark.conf.get(key))
            spark.conf.set(key, value)

    yield change
    for key, value in saved.items():
        spark.conf.set(key, value)


def scanned(df):
    """Rows that the scan of a file brings up."""
    executed = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    return executed.collectLeaves().head().metrics().get("numOutputRows").get().value()


def test_a_small_batch_reads_its_own_members_of_a_large_dimension(spark, tmp_path):
    """Of a million members a batch of a hundred reads pages, and gets the keys of a whole read."""
    warehouse = Warehouse(spark, str(tmp_path), buckets=2)
    every = spark.range(1_000_000).select(F.format_string("i%07d", "id").alias("invoice_id"))
    values = {("d_invoice", "invoice_id"): F.col("invoice_id")}
    dims.insert_members(dims.offers(every, values), values, warehouse)
    wanted = [f"i{i * 9973:07d}" for i in range(100)]
    batch = frame(spark, "invoice_id string, vendor_id string", *[(i, "v") for i in wanted], (None, "v"), ("new", "v"))
    few = lookup.few_values(warehouse, batch, "invoice_id", "vendor_id")
    assert few == {"invoice_id": sorted([*wanted, "new"]), "vendor_id": ["v"]}
    members = warehouse.members("d_invoice", "invoice_id", few["invoice_id"])
    assert members.count() == 100
    assert scanned(members) <= 100 * 2 * 500 < scanned(warehouse.read("d_invoice"))
    # New members are found and keyed as over the whole dimension.
    dims.insert_members(dims.offers(batch, values), values, warehouse, {"d_invoice": few["invoice_id"]})
    stored = warehouse.read("d_invoice")
    assert stored.count() == 1_000_001 and stored.filter("invoice_id = 'new'").first()[0] == 1_000_001
    # A large batch, or a table whose highest key is not recorded, reads all.
    assert lookup.few_values(warehouse, every, "invoice_id") is None
    assert lookup.few_values(SessionTables(spark), batch, "invoice_id") is None


def test_few_blank_members_are_asked_for_in_the_scan_of_a_fact(spark, tmp_path, monkeypatch):
    """Of a fact in the order of its keys only the pages with a blank key are read."""
    path = str(tmp_path / "fact")
    spark.range(200_000).coalesce(1).select(F.floor(F.col("id") / 4).alias("item_key")).write.option(
        "parquet.page.row.count.limit", "1000").parquet(path)
    fact = spark.read.parquet(path)
    hits = dims.referring(fact, "item_key", [77, 40_000, 60_000])
    assert "PushedFilters: [In(item_key" in plan(hits)
    assert hits.count() == 8
    assert scanned(hits) <= 2 * 1000 * 2 < scanned(fact)
    # Many blank members are joined, with the same result.
    items = frame(spark, "item_key long, item_name string", (77, " "), (60_000, None), (3, "nail"), (40_000, ""))
    held = {77: True, 40_000: True, 60_000: False}
    for few in (500, 2, 0):
        monkeypatch.setattr(dims, "FEW", few)
        found = dims.blank_members(items, "d_item", "item_name", [(fact, "item_key")])
        assert {r.item_key: r.referenced for r in found.collect()} == held
    assert dims.blank_members(items.limit(0), "d_item", "item_name", [(fact, "item_key")]).isEmpty()


def test_one_row_per_key_is_limited_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    text = plan(merge.last_wins(df, ["k"], ["id"]))
    assert text.index("WindowGroupLimit") < text.index("Exchange hashpartitioning")
    partial = text.rindex("WindowGroupLimit")
    assert partial > text.index("Exchange hashpartitioning") and "Partial" in text[partial:]


def test_window_and_merge_share_one_shuffle_of_the_batch(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    batch = spark.range(100).select((F.col("id") % 30).cast("string").alias("k"), "id")
    target = spark.range(10).select(F.col("id").cast("string").alias("k"), "id")
    last = merge.last_wins(batch, ["k"], ["id"])
    text = plan(merge.absent(last, target, ["k"]))
    assert text.count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("name", ["upsert_inventory", "insert_new_requests", "upsert_schedule",
                                  "upsert_issues", "upsert_worker_payments", "upsert_payload"])
def test_loads_have_no_pairwise_join_and_no_single_partition(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "SinglePartition" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "invoices")
    source(spark, SF, "invoice_master").withColumn("unused", F.lit(1)).write.parquet(path)
    columns = [*payments.INVOICE]
    text = plan(payments.readable(scan(spark, path, columns)).select("supplier_name"))
    assert "IsNotNull(supplier_name)" in text and "IsNotNull(created_date)" in text
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert "unused" not in schema and "amount_to_pay" not in schema


def test_members_scan_only_their_columns(spark, tmp_path):
    path = str(tmp_path / "stock")
    source(spark, SF, "inventory").write.parquet(path)
    checked = inventory.check(spark.read.parquet(path))
    text = plan(checked.select("item_name").distinct())
    assert "quantity" not in re.search(r"ReadSchema: struct<(.*?)>", text).group(1)


def test_hot_member_of_a_large_dimension_is_split(spark, settings):
    """A third of the rows name one member, another third none."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20000",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20000",
        spark__sql__shuffle__partitions="8",
    )
    n = 60000
    member = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, None).otherwise(
        F.concat(F.lit("m"), (F.col("id") % 500).cast("string")))
    facts = spark.range(0, n, 1, 8).select("id", member.alias("member"))
    dim = materialize(
        facts.filter("member IS NOT NULL").select("member").distinct().select(
            F.xxhash64("member").alias("k"), "member"), "dim")
    found = lookup.or_null(facts, [lookup.Lookup("member", dim, "member", "k", "member_key")])
    counted = found.groupBy((F.col("id") % 3).alias("r")).agg(F.count("member_key").alias("n"))
    joined = {r["r"]: r["n"] for r in counted.collect()}
    assert joined == {0: n // 3, 1: 0, 2: n // 3}
    assert "skew=true" in plan(counted)


def test_keys_are_given_by_range_not_in_one_task(spark):
    df = spark.range(1000).select(F.md5(F.col("id").cast("string")).alias("m")).repartition(4)
    assert "Exchange rangepartitioning" in plan(df.orderBy("m"))
    numbered = keys.number_rows(df, ["m"], "test")
    assert "SinglePartition" not in plan(numbered)
    assert "Window" not in plan(numbered)


def test_lookups_of_a_load_do_not_shuffle_facts_for_small_dimensions(spark):
    tables = SessionTables(spark)
    requests.load_dimensions(source(spark, SF, "employees"), source(spark, SF, "inventory_requests"),
                             tables)
    stored = materialize(source(spark, SF, "inventory_requests"), "requests")
    text = plan(requests.resolve(requests.check(stored), tables))
    # Names are reduced to one key on the dimension side, the facts stay in place.
    facts = [line for line in text.splitlines() if "hashpartitioning(status" in line]
    assert not facts
