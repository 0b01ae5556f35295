"""Catalog layers, schema replacement, stored histories, partition refresh, reconciled CSV, join-first report."""

import datetime as dt
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F
from shop import ORDERS, FrameSource

from ledgerline.operators import history as H
from ledgerline.operators import quality as Q
from ledgerline.operators import reports as R
from ledgerline.operators.scd2 import apply_scd2
from ledgerline.operators.silver import ORDER_PARTITIONS
from ledgerline.plans import tables as TB
from ledgerline.plans.lakehouse import Lakehouse
from ledgerline.session import local_path
from ledgerline.sources import reconcile
from ledgerline.sources.files import bucket_number
from ledgerline.sources.model import OrderModel
from ledgerline.streaming.quality_stream import CheckedStream

AS_OF = dt.date(2026, 6, 15)


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------ layers

class Counting(FrameSource):
    def __init__(self, spark):
        super().__init__(spark)
        self.read = Counter()

    def __getattribute__(self, name):
        if name in TB.BRONZE:
            self.read[name] += 1
        return super().__getattribute__(name)


def test_layers_read_raw_once_and_give_the_same_tables(spark):
    source = Counting(spark)
    layers, lazy = TB.Layers.build(source, buckets=2), Lakehouse(FrameSource(spark))
    assert set(source.read) == set(TB.BRONZE)
    # the change feeds of the fixture are made from its orders and items: one more look at each
    assert max(source.read.values()) <= 2 and source.read["products"] == 1
    for name in ("dim_customers", "dim_products", "fact_orders", "fact_order_items", "pipeline_dim_products"):
        want = getattr(lazy, name)
        got = layers.table(name) if name != "dim_customers" else layers.dim_customers
        assert rows(got) == rows(want), name
    for name in ("history_orders", "history_order_items"):
        assert rows(layers.table(name).drop(TB.END_MONTH)) == rows(getattr(lazy, name))
    t = layers.table
    assert "Exchange hashpartitioning(order_id" not in plan(t("fact_orders").join(t("fact_order_items"), "order_id"))
    assert rows(R.top_products(t("fact_order_items"), t("fact_orders"), t("dim_products"), R.rolling_30d(AS_OF))) == rows(
        R.top_products(lazy.fact_order_items, lazy.fact_orders, lazy.dim_products, R.rolling_30d(AS_OF)))
    # the tables of a layer read the tables of the one before, not the source
    files = {f.split("/")[-2] for f in layers.fact_orders.inputFiles()}
    assert files == {"silver_orders"}


# ------------------------------------------------------------ schema replacement

def test_replacing_a_schema_swaps_the_table_whole(spark):
    db = TB.create_database(spark)
    first = spark.createDataFrame([(1, "x", 2)], "id long, v string, n int")
    assert TB.replace_table(first, f"{db}.things") == {"added": ["id", "v", "n"], "dropped": [], "retyped": []}
    reader = spark.table(f"{db}.things")
    other = reader.select("id", F.col("n").cast("double").alias("n"), F.lit(True).alias("w"))  # reads what it replaces
    assert TB.replace_table(other, f"{db}.things") == {"added": ["w"], "dropped": ["v"], "retyped": ["n"]}
    assert reader.collect() == first.collect()               # begun before the swap: the old table, whole
    assert spark.table(f"{db}.things").collect() == [(1, 2.0, True)]
    TB.replace_table(spark.createDataFrame([], "a int"), f"{db}.things")
    assert spark.table(f"{db}.things").dtypes == [("a", "int")]
    names = {r.tableName for r in spark.sql(f"SHOW TABLES IN {db}").collect()}
    assert names == {"things", "things__v2", "things__v3"}   # one earlier version is kept


def test_a_failed_replacement_leaves_the_old_table(spark):
    db = TB.create_database(spark)
    TB.replace_table(spark.createDataFrame([(1,)], "id long"), f"{db}.things")
    bad = spark.range(3).select(F.raise_error(F.lit("lost")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        TB.replace_table(bad, f"{db}.things")
    assert spark.table(f"{db}.things").collect() == [(1,)]


# ------------------------------------------------------------ stored histories

@pytest.fixture(scope="module")
def stored(spark):
    t = lambda m, d=1: dt.datetime(2026, m, d)
    changes = [(k, 100 + k % 3, s, t(m)) for k in range(6) for m, s in ((1, "a"), (2, "b"), (5, "c")) if k != 4 or m > 2]
    feed = spark.createDataFrame(changes, "item long, order_id long, status string, at timestamp_ntz")
    from ledgerline.operators.scd2 import apply_scd2
    items = apply_scd2(feed, ["item"], "at", ["status"])
    orders = apply_scd2(feed.groupBy("order_id", "at").agg(F.max("status").alias("total")), ["order_id"], "at", ["total"])
    db = TB.create_database(spark)
    TB.write_history(items, f"{db}.items", ["order_id"], 4)
    TB.write_history(orders, f"{db}.orders", ["order_id"], 4)
    return db, items, orders


def test_current_reads_one_partition_and_joins_in_place(spark, stored):
    db, items, orders = stored
    current = TB.stored_current(spark.table(f"{db}.items"))
    assert "PartitionFilters: [isnotnull(end_month" in plan(current) and "999912" in plan(current)
    assert rows(current) == rows(H.current_state(items))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = TB.stored_current_join(spark.table(f"{db}.orders").drop("at"), spark.table(f"{db}.items"), "order_id")
        assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
        want = H.current_join(orders.drop("at"), items, "order_id")
        assert rows(joined) == rows(want)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("when", [dt.datetime(2025, 12, 31), dt.datetime(2026, 2, 1), dt.datetime(2026, 4, 30), dt.datetime(2027, 1, 1)])
def test_point_in_time_leaves_out_what_ended_before(spark, stored, when):
    db, items, _ = stored
    got = TB.stored_as_of(spark.table(f"{db}.items"), when, ["item", "status"])
    assert rows(got) == rows(H.as_of(items, when, ["item", "status"]))
    assert "end_month" in plan(got).split("PartitionFilters: [")[1].split("]")[0]


# ------------------------------------------------------------ one shuffle for windows and buckets

@pytest.fixture
def item_changes(spark):
    t = lambda d: dt.datetime(2026, 1, d)
    plain = [(i, 100 + i // 3, f"s{d % 3}", t(d)) for i in range(40) for d in (1, 2, 5, 5)]
    odd = [(90, 100, "a", t(1)), (90, 101, "a", t(2)), (90, None, "b", t(3)), (91, None, "a", t(1)), (91, None, "b", t(2)),
           (None, 100, "a", t(1)), (None, 105, "b", t(2)), (92, 103, "a", None)]
    return spark.createDataFrame(plain + odd, "item long, order_id long, status string, at timestamp_ntz")


def test_a_placed_history_is_shuffled_once_and_is_the_history(spark, item_changes):
    orders = item_changes.where("item < 90")
    one = TB.placed_history(orders, ["order_id"], "at", ["status"], ["order_id"], 4)
    assert plan(one).count("Exchange") == 1
    assert rows(one) == rows(apply_scd2(orders, ["order_id"], "at", ["status"]))
    items = TB.placed_history(orders, ["item"], "at", ["status"], ["order_id"], 4)
    assert plan(items).count("Exchange") == 1
    assert rows(items) == rows(apply_scd2(orders, ["item"], "at", ["status"]))


def test_an_item_that_moves_to_another_order_keeps_its_versions(spark, item_changes):
    want = rows(apply_scd2(item_changes, ["item"], "at", ["status"]))
    hot = {"rows_per_chunk": 3, "sample_fraction": 1.0, "ranges": 3}
    for options in ({}, hot):
        got = TB.placed_history(item_changes, ["item"], "at", ["status"], ["order_id"], 4, **options)
        assert rows(got) == want
    db = TB.create_database(spark)
    TB.write_history(got, f"{db}.items", ["order_id"], 4, placed=True)
    assert rows(spark.table(f"{db}.items").drop(TB.END_MONTH)) == want


def test_placed_rows_lie_in_their_bucket(spark, item_changes):
    db = TB.create_database(spark)
    TB.write_history(TB.placed_history(item_changes, ["order_id"], "at", ["status"], ["order_id"], 4), f"{db}.orders",
                     ["order_id"], 4, placed=True)
    lies = spark.table(f"{db}.orders").select(
        F.regexp_extract(F.input_file_name(), "_0*([0-9]+)[.]c", 1).cast("int").alias("file"), bucket_number(4, ["order_id"]).alias("own"))
    assert lies.where("file <> own or file is null").count() == 0 and lies.count() > 0


def test_the_windows_shuffle_carries_each_column_once(item_changes):
    history = apply_scd2(item_changes, ["item"], "at", ["status"], rows_per_chunk=0)
    assert "hashpartitioning(item" in plan(history)
    below = plan(history).split("hashpartitioning(item")[1]
    assert "struct" not in below                             # the tie break's struct was shuffled beside its columns


def test_change_feed_shuffles_lines_once(spark, scratch):
    root = scratch("feed")
    spark.sql("""SELECT 1L o_orderkey, 1L o_custkey, 'F' o_orderstatus, 2.0 o_totalprice, timestamp_ntz'1997-01-01' o_orderdate,
                 '5-LOW' o_orderpriority""").write.parquet(f"{root}/orders.parquet")
    spark.sql("""SELECT k l_orderkey, timestamp_ntz'1997-01-02' l_shipdate, s l_linestatus
                 FROM VALUES (1L, 'F'), (1L, 'O'), (2L, 'F'), (NULL, 'F') AS v(k, s)""").write.parquet(f"{root}/lineitem.parquet")
    feed = OrderModel(spark, root).order_change_feed()
    assert [(r.order_id, r.order_status) for r in feed.orderBy("updated_at").collect()] == [(1, "Initial"), (1, "In-Progress")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert plan(OrderModel(spark, root).order_change_feed()).count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tables_are_packed_and_bronze_lies_in_order(spark):
    layers = TB.Layers.build(FrameSource(spark), buckets=2, histories=False)
    assert spark.conf.get(TB.SPLIT) != TB.SORTED_SPLIT
    for name in ("bronze_order_items", "fact_order_items"):
        for path in layers.table(name).inputFiles():
            assert ".zstd." in path
    for path in layers.table("bronze_order_items").inputFiles():
        keys = [tuple(r) for r in spark.read.parquet(path).select(*TB.BRONZE_ORDER["order_items"]).collect()]
        assert keys == sorted(keys)


# ------------------------------------------------------------ refresh

def files_of(root):
    return {os.path.join(d, f) for d, _, names in os.walk(local_path(root)) for f in names if f.endswith(".parquet")}


def test_a_new_arrival_folder_rewrites_only_its_days(spark, scratch):
    raw = FrameSource(spark).orders()
    root = scratch("refresh")
    raw.write.partitionBy(*TB.ARRIVAL).parquet(f"{root}/raw")
    scan = spark.read.parquet(f"{root}/raw")
    early = scan.where("month = 5")
    early_facts = TB.order_facts(early)
    early_facts.write.partitionBy(*ORDER_PARTITIONS).parquet(f"{root}/facts")
    TB.dependencies(early).write.partitionBy(*TB.ARRIVAL).parquet(f"{root}/depends")
    before = files_of(f"{root}/facts")
    touched = {tuple(r) for r in TB.refresh_orders(scan, 2026, 6, root).collect()}
    days = {(r[2].year, r[2].month, r[2].day) for r in ORDERS if r[10] == 6}
    assert touched == days
    kept = before & files_of(f"{root}/facts")
    assert {f for f in before if not any(f"order_month={m}/order_day={d}/" in f for _, m, d in days)} == kept
    full = TB.order_facts(scan)
    got = spark.read.parquet(f"{root}/facts").select(*full.columns)
    assert rows(got) == rows(full)
    TB.refresh_orders(scan, 2026, 6, root)                    # a repeated refresh changes nothing
    assert rows(spark.read.parquet(f"{root}/facts").select(*full.columns)) == rows(full)


# ------------------------------------------------------------ reconciled CSV

def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_columns_are_matched_by_name_and_types_widened(spark, scratch):
    root = local_path(scratch("mixed"))
    put(f"{root}/month=05/a.csv", "id,price,when,big,flag,note\n1,10,2026-05-01,1,true,\n2,20,2026-05-02,2,FALSE,x\n")
    put(f"{root}/month=06/b.csv", "price,id,flag,when,extra\n1.5,3,true,2026-06-01 10:30:00,7\n,4,,,\n")
    put(f"{root}/month=06/c.csv", "big,id\n9999999999,5\n\"7\",6,too,many\n")
    scan = reconcile.scan(spark, root)
    assert scan.schema == {"id": "int", "price": "double", "when": "timestamp_ntz", "big": "bigint", "flag": "boolean",
                           "note": "string", "extra": "int"}
    per_file = {os.path.basename(r._file): r for r in scan.types.collect()}
    assert per_file["a.csv"].price == "int" and per_file["b.csv"].price == "double" and per_file["c.csv"].price is None
    assert per_file["a.csv"].when == "date" and per_file["b.csv"].when == "timestamp_ntz"
    got = {r.id: r for r in scan.rows.collect()}
    assert sorted(got) == [1, 2, 3, 4, 5, 6] and got[3].price == 1.5 and got[1].price == 10.0
    assert got[1].when == dt.datetime(2026, 5, 1) and got[3].month == 6 and got[1].month == 5
    assert got[5].big == 9999999999 and got[4].flag is None and got[2].flag is False
    assert scan.corrupt_rows() == 1


def test_a_single_file_text_and_zones(spark, scratch):
    path = local_path(scratch("single")) + ".csv"
    put(path, "sku,at,code,empty\n100-01,2026-05-15 11:00:00 America/New_York,007,\n,2026-05-16 11:00:00 Europe/Berlin,8,\n")
    scan = reconcile.scan(spark, path)
    assert scan.schema == {"sku": "string", "at": "timestamp", "code": "int", "empty": "string"}
    assert scan.rows.select(F.date_format("at", "yyyy-MM-dd HH:mm").alias("t")).collect()[0].t == "2026-05-15 15:00"
    assert scan.corrupt_rows() == 0 and scan.rows.count() == 2


def test_widest():
    assert reconcile.widest(["int", "double"]) == "double" and reconcile.widest(["date", "timestamp"]) == "timestamp"
    assert reconcile.widest(["int", "date"]) == "string" and reconcile.widest([]) == "string"
    assert reconcile.widest(["boolean", "int"]) == "string" and reconcile.widest(["bigint", "int"]) == "bigint"


# ------------------------------------------------------------ join first

def test_join_first_counts_every_dimension_row(spark):
    items = spark.createDataFrame([(1, "A", 2, 5.0, "Delivered"), (1, "B", 3, 1.0, "Delivered"), (2, "A", 1, 7.0, "Delivered")],
                                  "order_id long, product_sku string, quantity int, unit_price double, item_status string")
    orders = spark.createDataFrame([(1, "Complete", dt.date(2026, 6, 1), 2026, 6), (2, "Complete", dt.date(2026, 6, 2), 2026, 6)],
                                   "order_id long, order_status string, order_date date, order_year int, order_month int")
    twice = spark.createDataFrame([("A", "Shoe", "x"), ("A", "Shoe", "x"), ("B", "Cap", "y"), ("B", "Old cap", "y")],
                                  "product_sku string, product_name string, category string")
    window = R.rolling_30d(AS_OF)
    joined = R.top_products_joined(items, orders, twice, window, top=5).collect()
    plain = R.top_delivered(items, orders, twice, window, top=5).collect()
    assert [(r.product_name, r.total_quantity_sold, r.number_of_orders, r.total_revenue, r.avg_unit_price) for r in joined] == [
        ("Shoe", 6, 2, 34.0, 6.0), ("Cap", 3, 1, 3.0, 1.0), ("Old cap", 3, 1, 3.0, 1.0)]
    assert sorted((r.product_name, r.total_quantity_sold) for r in plain) == [
        ("Cap", 3), ("Old cap", 3), ("Shoe", 3), ("Shoe", 3)]
    once = twice.dropDuplicates(["product_sku"])
    assert [r[:1] + r[3:] for r in R.top_products_joined(items, orders, once, window, top=5).collect()] == \
        [r[:1] + r[3:] for r in R.top_delivered(items, orders, once, window, top=5).collect()]
    text = R.top_products_joined(items, orders, twice, window)._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Aggregate") < text.index("Join")       # the aggregate stays above the join


# ------------------------------------------------------------ quality in a stream

def test_stream_metrics_add_up_to_the_batch(spark, scratch):
    df = spark.createDataFrame([("A", 1.0), ("B", -2.0), (None, None), ("D", 0.0), ("E", -1.0)],
                               "product_sku string, price double")
    root = scratch("checked")
    df.repartition(3).write.parquet(f"{root}/source")
    target = CheckedStream(spark, f"{root}/target", Q.PRODUCT_RULES, "p", df.schema)
    target.run(f"{root}/source")
    want = Q.expectation_metrics(df, Q.PRODUCT_RULES, "p")
    assert rows(target.metrics()) == rows(want)
    assert rows(target.rows()) == rows(Q.expect_or_drop(df, Q.PRODUCT_RULES))
    batches = target.batch_metrics().select("batch_id").distinct().count()
    target.apply_batch(df.limit(0), batches)                  # an empty batch adds nothing
    target.apply_batch(df.limit(0), batches)                  # nor does its replay
    assert rows(target.metrics()) == rows(want)
    assert rows(target.rows()) == rows(Q.expect_or_drop(df, Q.PRODUCT_RULES))
