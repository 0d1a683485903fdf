import pytest
from pyspark.sql import functions as F

from helpers import frame, rows, session_tables
from starload.operators import checks, clean, dims, keys, lookup, merge
from starload.schemas import TABLES


def test_first_broken_rule_wins(spark):
    df = frame(spark, "a int, b int", (1, None), (None, None), (1, 1))
    once = clean.classify(df, [("no a", F.col("a") > 0)])
    twice = clean.classify(once, [("no b", F.col("b") > 0)])
    assert rows(twice, clean.REASON) == [("no a",), ("no b",), (None,)]
    assert rows(clean.kept(twice)) == [(1, 1)]


def test_last_and_first_take_nulls_as_latest(spark):
    df = frame(spark, "k string, t int, v string", ("x", 1, "a"), ("x", None, "b"), ("x", 2, "c"),
               ("y", 1, "d"), ("y", 1, "e"))
    assert rows(merge.last_wins(df, ["k"], ["t", "v"])) == [("x", None, "b"), ("y", 1, "e")]
    assert rows(merge.first_wins(df, ["k"], ["t", "v"])) == [("x", 1, "a"), ("y", 1, "d")]


@pytest.mark.parametrize("parts", [2, 5, 16])
def test_positions_are_dense_and_ordered(spark, parts):
    df = spark.range(1500).select(F.md5(F.col("id").cast("string")).alias("m")).repartition(parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = keys.number_rows(df, ["m"], "test")
        assert len(numbered.inputFiles()) > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = sorted(r[0] for r in df.collect())
    assert [r["m"] for r in numbered.orderBy("_position").collect()] == want
    assert [r[0] for r in numbered.select("_position").orderBy("_position").collect()] == list(
        range(1500))


def test_group_starts_across_partitions(spark):
    df = spark.range(900).select(
        F.concat(F.lit("g"), (F.col("id") % 3).cast("string")).alias("g"), F.col("id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered, firsts = keys.number_groups(df, "g", ["id"], "test")
        assert firsts == {"g0": 0, "g1": 300, "g2": 600}
        assert numbered.filter("g = 'g1' AND _position NOT BETWEEN 300 AND 599").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_bucket_keys_stay_unique_over_loads(spark):
    target = spark.createDataFrame([], "n long, k long")
    for start in (0, 50, 200):
        new = spark.range(start, start + 100).select(F.col("id").alias("n"))
        new = merge.absent(new, target, ["n"])
        keyed = keys.assign_bucket_keys(new, target, ["n"], "k", 4).select("n", "k")
        target = spark.createDataFrame(target.unionByName(keyed).collect(), "n long, k long")
    assert target.count() == 250
    assert target.select("k").distinct().count() == 250
    assert target.filter("k < 1").count() == 0


def test_members_keep_their_keys(spark):
    tables = session_tables(spark, d_item=frame(
        spark, "item_key long, item_name string", (7, "nail"), (3, "cog")))
    batch = frame(spark, "i string", ("bolt",), ("nail",), ("bolt",), (None,), ("axe",))
    values = {("d_item", "item_name"): F.col("i")}
    new = dims.new_members(dims.offers(batch, values), values, {"d_item": tables.read("d_item")})
    assert rows(new["d_item"]) == [(8, "axe"), (9, "bolt")]


def test_lookups(spark):
    dim = frame(spark, "k long, n string", (1, "a"), (2, "b"))
    df = frame(spark, "x string, y string", ("a", "b"), ("z", "z"), ("a", "z"), (None, "a"))
    both = [lookup.Lookup("x", dim, "n", "k", "xk"), lookup.Lookup("y", dim, "n", "k", "yk")]
    assert rows(lookup.or_null(df, both), "xk", "yk") == [(1, 2), (1, None), (None, 1),
                                                         (None, None)]
    assert rows(lookup.or_reject(df, both), "x", "y", clean.REASON) == [
        ("a", "b", None), ("a", "z", "unknown y"), ("z", "z", "unknown x"),
        (None, "a", "unknown x")]
    with pytest.raises(lookup.UnknownMember):
        lookup.or_fail(df, both[0])
    assert rows(lookup.misses(df, both[0])) == [("z", 1), (None, 1)]


def test_numeric_source_ids_meet_text_members(spark):
    tables = session_tables(spark)
    rows_in = frame(spark, "project_id int, project_name string", (7, "Seven"), (None, "x"))
    for name in ("Seven", "Sept"):
        tables.replace("d_project", dims.overwrite(
            rows_in.withColumn("project_name", F.lit(name)), "d_project",
            tables.read("d_project"), ["project_name"]))
    tables.append("d_vendor", dims.first_seen(
        frame(spark, "vendor_id int, vendor_name string", (1, "a")), "d_vendor",
        tables.read("d_vendor")))
    assert rows(tables.read("d_project")) == [(1, "7", "Sept")]
    one = lookup.Lookup("project_id", tables.read("d_project"), "project_id", "project_key", "k")
    assert rows(lookup.or_null(rows_in, [one]), "project_id", "k") == [(7, 1), (None, None)]


def test_checks(spark):
    fact = frame(spark, "inventory_id string, item_key long, project_key long, date_key int",
                 ("1", 1, 1, 20240101), ("1", 9, None, 20240101))
    tables = session_tables(
        spark, d_item=frame(spark, "item_key long, item_name string", (1, "nail")),
        d_project=frame(spark, "project_key long, project_name string", (1, "p")),
        d_date=frame(spark, "date_key int", (20240101,)))
    assert rows(checks.repeated_keys(fact, ["inventory_id"])) == [("1", 2)]
    assert rows(checks.orphans(fact, "item_key", tables.read("d_item"), "item_key")) == [(9, 1)]
    with pytest.raises(checks.ConstraintViolation, match="repeated inventory_id; item_key"):
        checks.verify(fact, "f_inventory", tables.read)
    checks.verify(fact.limit(1), "f_inventory", tables.read)
    long = frame(spark, "vendor_id string, vendor_name string", ("v" * 21, "x"), ("v", "x" * 300))
    assert rows(checks.too_long(long, "d_vendor")) == [("vendor_id", 1), ("vendor_name", 1)]


def test_contracts_refer_to_columns_that_exist():
    for table in TABLES.values():
        assert set(table.natural) <= set(table.names)
        for column, (target, key) in table.references.items():
            assert column in table.names and key in TABLES[target].names
