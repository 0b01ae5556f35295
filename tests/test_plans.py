"""Plan shape checks: pruning, pushdown and the join/aggregate order."""

import datetime as dt

from ledgerline.operators import reports as R
from ledgerline.plans.lakehouse import Lakehouse
from ledgerline.sources.files import read_table
from ledgerline.sources.model import OrderModel

SF = "/root/testdata/sf0.001"


def plan_of(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return df._jdf.queryExecution().executedPlan().toString()


def partition_filters(plan: str, column: str) -> str:
    """The PartitionFilters list of the scan that outputs ``column``."""
    for scan in plan.split("FileScan")[1:]:
        head = scan.split("\n")[0]
        if column in head.split("]")[0]:
            return head.split("PartitionFilters: [")[1].split("]")[0]
    raise AssertionError(f"no scan with {column} in plan")


def test_previous_month_report_prunes_partitions(spark, scratch):
    lh = Lakehouse(OrderModel(spark, SF))
    paths = lh.materialize(scratch("lake"), only=("gold/fact_orders", "gold/fact_order_items",
                                                  "gold/dim_products"))
    orders = read_table(spark, paths["gold/fact_orders"])
    items = read_table(spark, paths["gold/fact_order_items"])
    dims = read_table(spark, paths["gold/dim_products"])
    as_of = dt.date(1998, 9, 1)
    rep = R.top_products(items, orders, dims, R.previous_calendar_month(as_of))
    part = partition_filters(plan_of(rep), "order_status")
    assert "(order_year" in part and "= 1998)" in part and "= 8)" in part
    # the rolling window states an implied month range on the partitions too
    roll = plan_of(R.top_products(items, orders, dims, R.rolling_30d(as_of)))
    assert "order_month" in partition_filters(roll, "order_status")
    assert rep.count() == 10


def test_report_reads_only_needed_columns(spark):
    lh = Lakehouse(OrderModel(spark, SF))
    rep = R.top_products(lh.fact_order_items, lh.fact_orders, lh.dim_products,
                         R.rolling_30d(dt.date(1998, 9, 1)))
    plan = plan_of(rep)
    schema = plan.split("lineitem.parquet")[1].split("ReadSchema: ")[1].split(">")[0]
    for unused in ("l_suppkey", "l_tax", "l_discount"):
        assert unused not in schema
    assert "TakeOrderedAndProject" in plan or "TakeOrdered" in plan


def test_materialized_pipeline_tables_and_sql_reports(spark, scratch):
    from ledgerline.plans.sql_reports import register_table_views, run_report
    lh = Lakehouse(OrderModel(spark, SF))
    names = ("gold/fact_order_items", "gold/dim_products", "pipeline/dim_products",
             "pipeline/fact_orders", "pipeline/fact_order_items")
    paths = lh.materialize(scratch("lake2"), only=names)
    assert set(paths) == set(names)
    hist = read_table(spark, paths["pipeline/fact_orders"])
    assert hist.count() == lh.history_orders.count() == lh.written_rows["pipeline/fact_orders"]
    assert sorted(hist.columns) == sorted(lh.history_orders.columns)
    register_table_views(spark, paths)
    as_of = dt.date(1998, 9, 1)
    rep = run_report(spark, "top", as_of, current_only=True, with_avg_price=True)
    assert "order_month" in partition_filters(plan_of(rep), "order_status")
    got = rep.collect()
    want = R.top_products(R.current_only(lh.history_order_items), R.current_only(lh.history_orders),
                          lh.pipeline_dim_products, R.rolling_30d(as_of),
                          with_avg_price=True).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]


def test_bucketed_facts_join_without_shuffle(spark):
    from ledgerline.plans.sql_reports import run_report
    lh = Lakehouse(OrderModel(spark, SF))
    t = lh.materialize_catalog("lake_gold", buckets=8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rep = run_report(spark, "top", dt.date(1998, 9, 1),
                         tables={"items": t["fact_order_items"], "orders": t["fact_orders"],
                                 "products": t["dim_products"]})
        plan = plan_of(rep)
        assert "SortMergeJoin" in plan
        assert "hashpartitioning(order_id" not in plan       # both sides bucketed
        want = R.top_products(lh.fact_order_items, lh.fact_orders, lh.dim_products,
                              R.rolling_30d(dt.date(1998, 9, 1)))
        assert [tuple(r) for r in rep.collect()] == [tuple(r) for r in want.collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_latest_state_queries_have_no_window(spark):
    import __spark_entry__ as E
    for name in ("report_scd2_top10_30d", "report_scd2_category_30d", "report_scd2_top10_prev_month",
                 "report_top1_delivered_30d", "scd2_current_orders", "scd2_current_items",
                 "scd2_current_join", "filter_current_orders_since"):
        df = E.queries()[name](spark, "/root/testdata/sf0.001")
        assert "Window" not in df._jdf.queryExecution().executedPlan().toString(), name


def test_single_key_lookup_filters_below_the_window(spark):
    import __spark_entry__ as E
    df = E.queries()["scd2_order_lookup"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("_orderkey,7)") >= plan.count("PushedFilters") == 3
