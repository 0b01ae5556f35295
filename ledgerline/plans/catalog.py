"""Registry of named queries: a Spark callable and its DuckDB oracle each.

Every callable takes ``(spark, sf_dir)``, reads the driver tables of that
folder through ``OrderModel`` and returns a lazy DataFrame.  The fixed
parameters (report date, since-date, as-of instants) replace the clock so
results are reproducible.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import oracle as O
from ledgerline.functions.columns import round_half_up
from ledgerline.operators import history as H
from ledgerline.operators import profile as P
from ledgerline.operators import quality as Q
from ledgerline.operators import reports as R
from ledgerline.operators import silver as S
from ledgerline.plans.lakehouse import Lakehouse
from ledgerline.sources.model import OrderModel

AS_OF = O.AS_OF
SINCE = O.SINCE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None, ctes: dict[str, str] | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql if sql.startswith("WITH ") else O.with_ctes(sql, ctes)
        return fn
    return deco


def lake(spark: SparkSession, sf_dir: str, **kw) -> Lakehouse:
    return Lakehouse(OrderModel(spark, sf_dir), **kw)


# --------------------------------------------------------------------------
# Profiling of the raw tables
# --------------------------------------------------------------------------
_ORDER_FIELDS = [("order_id", "bigint"), ("customer_id", "bigint"),
                 ("ordered_at", "timestamp_ntz"), ("order_status", "string"),
                 ("subtotal_amount", "double"), ("tax_amount", "double"),
                 ("shipping_fee", "double"), ("total_amount", "double"),
                 ("updated_at", "timestamp_ntz"), ("year", "int"), ("month", "int")]


@register("profile_schema", " UNION ALL ".join(
    f"SELECT CAST({i + 1} AS INTEGER) AS ordinal, '{c}' AS column_name, '{t}' AS data_type, "
    f"count(*) - count({c}) AS null_count, count({c}) AS non_null_count FROM orders_raw"
    for i, (c, t) in enumerate(_ORDER_FIELDS)))
def profile_schema(spark, sf):
    return P.schema_profile(lake(spark, sf).bronze_orders)


@register("profile_counts", """
    SELECT 'products' AS dataset, count(*) AS total_rows, count(*) FILTER (WHERE deleted_at IS NULL) AS active_rows FROM products_raw
    UNION ALL SELECT 'customers', count(*), count(*) FILTER (WHERE deleted_at IS NULL) FROM customers_raw
    UNION ALL SELECT 'orders', count(*), count(*) FILTER (WHERE order_status != 'Cancelled') FROM orders_raw
    UNION ALL SELECT 'order_items', count(*), count(*) FILTER (WHERE item_status != 'Cancelled') FROM items_raw""")
def profile_counts(spark, sf):
    lh = lake(spark, sf)
    return (P.live_counts(lh.bronze_products, "products", "deleted_at IS NULL")
            .unionByName(P.live_counts(lh.bronze_customers, "customers", "deleted_at IS NULL"))
            .unionByName(P.live_counts(lh.bronze_orders, "orders", "order_status != 'Cancelled'"))
            .unionByName(P.live_counts(lh.bronze_order_items, "order_items",
                                       "item_status != 'Cancelled'")))


@register("profile_categories",
          "SELECT count(DISTINCT category) AS category_count FROM products_raw")
def profile_categories(spark, sf):
    return P.distinct_count(lake(spark, sf).bronze_products, "category", "category_count")


@register("product_availability", """
    SELECT CASE WHEN deleted_at IS NULL THEN 'Active' ELSE 'Inactive' END AS product_availability,
           count(*) AS product_count
    FROM products_raw GROUP BY 1""")
def product_availability(spark, sf):
    return P.product_availability(lake(spark, sf).bronze_products)


@register("status_sorted", 'SELECT * FROM status_raw ORDER BY type, "order"')
def status_sorted(spark, sf):
    return lake(spark, sf).bronze_status.orderBy("type", "order")


@register("join_status_broadcast", """
    SELECT o.order_status, s."order" AS status_order, count(*) AS order_count
    FROM orders_raw o JOIN status_raw s ON s.type = 'order' AND s.status = o.order_status
    WHERE s."order" IS NOT NULL
    GROUP BY 1, 2""")
def join_status_broadcast(spark, sf):
    lh = lake(spark, sf)
    # The master holds one row per known (type, status) code: at most
    # len(STATUS_MASTER) rows, a bound fixed by construction.
    status = (lh.bronze_status.where((F.col("type") == "order") & F.col("order").isNotNull())
              .select(F.col("status").alias("order_status"), F.col("order").alias("status_order")))
    return (lh.bronze_orders.join(F.broadcast(status), "order_status")
            .groupBy("order_status", "status_order")
            .agg(F.count(F.lit(1)).alias("order_count")))


# --------------------------------------------------------------------------
# Silver
# --------------------------------------------------------------------------
@register("silver_status", "SELECT * FROM status_raw")
def silver_status(spark, sf):
    return lake(spark, sf).silver_status


@register("silver_products", "SELECT * FROM silver_products")
def silver_products(spark, sf):
    return lake(spark, sf).silver_products


@register("silver_customers", "SELECT * FROM silver_customers")
def silver_customers(spark, sf):
    return lake(spark, sf).silver_customers


@register("silver_order_items", "SELECT * FROM silver_items")
def silver_order_items(spark, sf):
    return lake(spark, sf).silver_order_items


@register("silver_orders_active", "SELECT * FROM silver_orders WHERE order_status != 'Cancelled'")
def silver_orders_active(spark, sf):
    return lake(spark, sf).silver_orders_active


@register("silver_orders_inactive", "SELECT * FROM silver_orders WHERE order_status = 'Cancelled'")
def silver_orders_inactive(spark, sf):
    return lake(spark, sf).silver_orders_inactive


_SP = "'America/Sao_Paulo'"


@register("silver_utc_columns", f"""
    SELECT * EXCLUDE (ordered_at, updated_at),
           timezone('UTC', timezone({_SP}, ordered_at)) AS ordered_at,
           timezone('UTC', timezone({_SP}, updated_at)) AS updated_at,
           CAST(year(timezone('UTC', timezone({_SP}, ordered_at))) AS INTEGER) AS order_year,
           CAST(month(timezone('UTC', timezone({_SP}, ordered_at))) AS INTEGER) AS order_month,
           CAST(day(timezone('UTC', timezone({_SP}, ordered_at))) AS INTEGER) AS order_day
    FROM orders_raw""")
def silver_utc_columns(spark, sf):
    """Orders recorded in São Paulo wall-clock time, converted to UTC."""
    return S.silver_orders(lake(spark, sf).bronze_orders, source_zone="America/Sao_Paulo")


# --------------------------------------------------------------------------
# Gold
# --------------------------------------------------------------------------
@register("gold_dim_customers", "SELECT * FROM dim_customers")
def gold_dim_customers(spark, sf):
    return lake(spark, sf).dim_customers


@register("gold_dim_products", "SELECT * FROM dim_products")
def gold_dim_products(spark, sf):
    return lake(spark, sf).dim_products


@register("gold_fact_orders", "SELECT * FROM fact_orders")
def gold_fact_orders(spark, sf):
    return lake(spark, sf).fact_orders


@register("gold_fact_order_items", "SELECT * FROM fact_items")
def gold_fact_order_items(spark, sf):
    return lake(spark, sf).fact_order_items


@register("stage_fact_orders", "SELECT * FROM stage_orders")
def stage_fact_orders(spark, sf):
    return lake(spark, sf).stage_fact_orders


@register("stage_fact_order_items", "SELECT * FROM stage_items")
def stage_fact_order_items(spark, sf):
    return lake(spark, sf).stage_fact_order_items


@register("pipeline_dim_customers", "SELECT * FROM pipeline_dim_customers")
def pipeline_dim_customers(spark, sf):
    return lake(spark, sf).pipeline_dim_customers


@register("pipeline_dim_products", "SELECT * FROM pipeline_dim_products")
def pipeline_dim_products(spark, sf):
    return lake(spark, sf).pipeline_dim_products


# --------------------------------------------------------------------------
# Data quality
# --------------------------------------------------------------------------
@register("dq_customers", """
    SELECT * FROM customers_raw
    WHERE customer_id IS NOT NULL AND coalesce(email IS NOT NULL AND email LIKE '%@%', false)""")
def dq_customers(spark, sf):
    return Q.expect_or_drop(lake(spark, sf).bronze_customers, Q.CUSTOMER_RULES)


@register("dq_products", """
    SELECT * FROM products_raw WHERE product_sku IS NOT NULL AND coalesce(price >= 0, false)""")
def dq_products(spark, sf):
    return Q.expect_or_drop(lake(spark, sf).bronze_products, Q.PRODUCT_RULES)


@register("dq_metrics", """
    SELECT 'dim_customers' AS dataset, 'valid_customer_id' AS rule,
           count(*) FILTER (WHERE customer_id IS NOT NULL) AS passed_records,
           count(*) FILTER (WHERE customer_id IS NULL) AS failed_records FROM dim_customers
    UNION ALL
    SELECT 'dim_customers', 'valid_email',
           count(*) FILTER (WHERE coalesce(email IS NOT NULL AND email LIKE '%@%', false)),
           count(*) FILTER (WHERE NOT coalesce(email IS NOT NULL AND email LIKE '%@%', false))
    FROM dim_customers
    UNION ALL
    SELECT 'dim_products', 'valid_product_sku',
           count(*) FILTER (WHERE product_sku IS NOT NULL),
           count(*) FILTER (WHERE product_sku IS NULL) FROM dim_products
    UNION ALL
    SELECT 'dim_products', 'valid_price',
           count(*) FILTER (WHERE coalesce(price >= 0, false)),
           count(*) FILTER (WHERE NOT coalesce(price >= 0, false)) FROM dim_products""")
def dq_metrics(spark, sf):
    lh = lake(spark, sf)
    return (Q.expectation_metrics(lh.dim_customers, Q.CUSTOMER_RULES, "dim_customers")
            .unionByName(Q.expectation_metrics(lh.dim_products, Q.PRODUCT_RULES, "dim_products")))


@register("dq_metrics_stream", ORACLE["dq_metrics"])
def dq_metrics_stream(spark, sf):
    """The same counts, observed per micro-batch of a stream and summed."""
    from ledgerline.session import scratch_path
    from ledgerline.streaming.quality_stream import CheckedStream
    lh, out = lake(spark, sf), None
    for df, rules, name in ((lh.dim_customers, Q.CUSTOMER_RULES, "dim_customers"),
                            (lh.dim_products, Q.PRODUCT_RULES, "dim_products")):
        root = scratch_path(spark, f"checked-{name}")
        df.repartition(3, F.xxhash64(*df.columns)).write.parquet(f"{root}/source")
        target = CheckedStream(spark, f"{root}/target", rules, name, df.schema)
        target.run(f"{root}/source")
        out = target.metrics() if out is None else out.unionByName(target.metrics())
    return out


# --------------------------------------------------------------------------
# Verification aggregates
# --------------------------------------------------------------------------
@register("verify_status", "SELECT type, count(*) AS total_status FROM status_raw GROUP BY type")
def verify_status(spark, sf):
    return P.count_by(lake(spark, sf).silver_status, ["type"], "total_status")


@register("verify_products",
          "SELECT active, count(*) AS product_count FROM silver_products GROUP BY active")
def verify_products(spark, sf):
    return P.count_by(lake(spark, sf).silver_products, ["active"], "product_count")


@register("verify_customers",
          "SELECT active, count(*) AS customer_count FROM silver_customers GROUP BY active")
def verify_customers(spark, sf):
    return P.count_by(lake(spark, sf).silver_customers, ["active"], "customer_count")


@register("verify_orders_by_month", """
    SELECT year, month, count(*) AS total_orders FROM orders_raw GROUP BY year, month
    ORDER BY year, month""")
def verify_orders_by_month(spark, sf):
    return P.count_by(lake(spark, sf).bronze_orders, ["year", "month"], "total_orders", order=True)


@register("verify_items_by_month", """
    SELECT year, month, count(*) AS total_items FROM items_raw GROUP BY year, month
    ORDER BY year, month""")
def verify_items_by_month(spark, sf):
    return P.count_by(lake(spark, sf).bronze_order_items, ["year", "month"], "total_items",
                      order=True)


@register("verify_orders_active", """
    SELECT order_status, count(*) AS order_count FROM silver_orders
    WHERE order_status != 'Cancelled' GROUP BY 1""")
def verify_orders_active(spark, sf):
    return P.count_by(lake(spark, sf).silver_orders_active, ["order_status"], "order_count")


@register("verify_orders_inactive", """
    SELECT order_status, count(*) AS order_count FROM silver_orders
    WHERE order_status = 'Cancelled' GROUP BY 1""")
def verify_orders_inactive(spark, sf):
    return P.count_by(lake(spark, sf).silver_orders_inactive, ["order_status"], "order_count")


@register("verify_items_discounted",
          "SELECT discounted, count(*) AS item_count FROM silver_items GROUP BY 1")
def verify_items_discounted(spark, sf):
    return P.count_by(lake(spark, sf).silver_order_items, ["discounted"], "item_count")


@register("verify_fact_orders", """
    SELECT order_status, count(*) AS order_count,
           CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue
    FROM fact_orders GROUP BY 1 ORDER BY order_count DESC, order_status""")
def verify_fact_orders(spark, sf):
    return P.status_distribution(lake(spark, sf).fact_orders)


@register("verify_fact_items", """
    SELECT item_status, count(*) AS item_count, CAST(sum(quantity) AS BIGINT) AS total_quantity,
           CAST(sum(CAST(quantity AS DECIMAL(12,0)) * CAST(unit_price AS DECIMAL(18,2))) AS DOUBLE)
             AS total_amount
    FROM fact_items GROUP BY 1 ORDER BY item_count DESC, item_status""")
def verify_fact_items(spark, sf):
    return P.item_status_distribution(lake(spark, sf).fact_order_items)


# --------------------------------------------------------------------------
# Samples and filters (the row limit is the feature: a sorted sample)
# --------------------------------------------------------------------------
@register("sample_latest_orders", """
    SELECT order_id, customer_id, order_date, order_status, total_amount FROM fact_orders
    ORDER BY order_date DESC, order_id LIMIT 5""")
def sample_latest_orders(spark, sf):
    return (lake(spark, sf).fact_orders
            .select("order_id", "customer_id", "order_date", "order_status", "total_amount")
            .orderBy(F.col("order_date").desc(), "order_id").limit(5))


@register("sample_products", """
    SELECT * FROM dim_products ORDER BY category, product_name, product_sku LIMIT 10""")
def sample_products(spark, sf):
    return lake(spark, sf).dim_products.orderBy("category", "product_name", "product_sku").limit(10)


@register("sample_customers", "SELECT * FROM dim_customers ORDER BY customer_id LIMIT 5")
def sample_customers(spark, sf):
    return lake(spark, sf).dim_customers.orderBy("customer_id").limit(5)


@register("sample_items", f"""
    SELECT order_item_id, order_id, product_sku, quantity, unit_price,
           {O.round2('quantity * unit_price')} AS line_total, item_status
    FROM fact_items
    ORDER BY order_item_id, updated_at, item_status, quantity, unit_price, product_sku
    LIMIT 10""")
def sample_items(spark, sf):
    items = lake(spark, sf).fact_order_items
    return (items.orderBy("order_item_id", "updated_at", "item_status", "quantity",
                          "unit_price", "product_sku")
            .select("order_item_id", "order_id", "product_sku", "quantity", "unit_price",
                    round_half_up(F.col("quantity") * F.col("unit_price")).alias("line_total"),
                    "item_status")
            .limit(10))


@register("filter_orders_since", f"""
    SELECT order_id, order_status, total_amount FROM fact_orders
    WHERE order_date >= {O._d(SINCE)}""")
def filter_orders_since(spark, sf):
    return R.orders_since(lake(spark, sf).fact_orders, SINCE)


@register("filter_current_orders_since", f"""
    SELECT order_id, order_status, total_amount FROM h_orders
    WHERE order_date >= {O._d(SINCE)} AND __CURRENT""")
def filter_current_orders_since(spark, sf):
    return R.orders_since(lake(spark, sf).current_orders, SINCE)


# --------------------------------------------------------------------------
# Reports on the plain gold tables
# --------------------------------------------------------------------------
def _window_30d(as_of=AS_OF) -> str:
    import datetime as dt
    start = as_of - dt.timedelta(days=30)
    return f"o.order_date >= {O._d(start)} AND o.order_date < {O._d(as_of)}"


def _prev_month(as_of=AS_OF) -> str:
    y, m = (as_of.year, as_of.month - 1) if as_of.month > 1 else (as_of.year - 1, 12)
    return f"o.order_year = {y} AND o.order_month = {m}"


def _sales_sql(items: str, orders: str, window: str, item_cond: str = "i.item_status != 'Cancelled'") -> str:
    return f"""
        SELECT i.product_sku, CAST(sum(i.quantity) AS BIGINT) AS quantity,
               count(DISTINCT i.order_id) AS orders,
               sum(CAST(i.quantity AS DECIMAL(12,0)) * CAST(i.unit_price AS DECIMAL(18,2))) AS revenue,
               sum({O.cents('i.unit_price')}) AS price_cents, count(i.unit_price) AS price_count
        FROM {items} i JOIN {orders} o ON i.order_id = o.order_id
        WHERE {window} AND o.order_status != 'Cancelled' AND {item_cond}
        GROUP BY i.product_sku"""


def _top_sql(sales: str, dims: str, avg: bool, top: int = 10) -> str:
    extra = (f", {O.avg_cents_half_up('s.price_cents', 's.price_count')} AS avg_unit_price"
             if avg else "")
    return f"""
        SELECT s.product_sku, p.product_name, p.category, s.quantity AS total_quantity_sold,
               s.orders AS number_of_orders, CAST(s.revenue AS DOUBLE) AS total_revenue{extra}
        FROM ({sales}) s JOIN {dims} p ON s.product_sku = p.product_sku
        ORDER BY total_quantity_sold DESC, s.product_sku LIMIT {top}"""


def _category_sql(sales: str, dims: str, avg: bool) -> str:
    if avg:
        # Mean of per-product means: per product the mean in 1e-12 units
        # (HALF_UP, as Spark's decimal division), then HALF_UP to cents.
        return f"""
            SELECT p.category, count(DISTINCT p.product_sku) AS unique_products,
                   CAST(sum(s.quantity) AS BIGINT) AS total_quantity_sold,
                   CAST(sum(s.orders) AS BIGINT) AS number_of_orders,
                   CAST(sum(s.revenue) AS DOUBLE) AS total_revenue,
                   {O.avg_cents_half_up('sum(s.avg_e12)', 'count(s.avg_e12) * 10000000000')} AS avg_unit_price
            FROM (SELECT *, (2 * price_cents * 10000000000 + price_count) // (2 * price_count) AS avg_e12
                  FROM ({sales})) s
            JOIN {dims} p ON s.product_sku = p.product_sku
            GROUP BY p.category ORDER BY total_revenue DESC"""
    return f"""
        SELECT p.category, CAST(sum(s.quantity) AS BIGINT) AS total_quantity_sold,
               count(DISTINCT p.product_sku) AS distinct_products,
               CAST(sum(s.orders) AS BIGINT) AS number_of_orders,
               CAST(sum(s.revenue) AS DOUBLE) AS total_revenue
        FROM ({sales}) s JOIN {dims} p ON s.product_sku = p.product_sku
        GROUP BY p.category ORDER BY total_quantity_sold DESC"""


@register("report_top10_30d",
          _top_sql(_sales_sql("fact_items", "fact_orders", _window_30d()), "dim_products", False))
def report_top10_30d(spark, sf):
    lh = lake(spark, sf)
    return R.top_products(lh.fact_order_items, lh.fact_orders, lh.dim_products,
                          R.rolling_30d(AS_OF))


@register("report_category_30d",
          _category_sql(_sales_sql("fact_items", "fact_orders", _window_30d()), "dim_products", False))
def report_category_30d(spark, sf):
    lh = lake(spark, sf)
    return R.category_sales(lh.fact_order_items, lh.fact_orders, lh.dim_products,
                            R.rolling_30d(AS_OF))


@register("report_top10_prev_month",
          _top_sql(_sales_sql("fact_items", "fact_orders", _prev_month()), "dim_products", False))
def report_top10_prev_month(spark, sf):
    lh = lake(spark, sf)
    return R.top_products(lh.fact_order_items, lh.fact_orders, lh.dim_products,
                          R.previous_calendar_month(AS_OF))


@register("report_category_prev_month",
          _category_sql(_sales_sql("fact_items", "fact_orders", _prev_month()), "dim_products", False))
def report_category_prev_month(spark, sf):
    lh = lake(spark, sf)
    return R.category_sales(lh.fact_order_items, lh.fact_orders, lh.dim_products,
                            R.previous_calendar_month(AS_OF))


# --------------------------------------------------------------------------
# Reports on the version-history tables (current versions)
# --------------------------------------------------------------------------
_CUR_ITEMS = "(SELECT * FROM h_items WHERE __CURRENT)"
_CUR_ORDERS = "(SELECT * FROM h_orders WHERE __CURRENT)"


def _scd_inputs(spark, sf):
    lh = lake(spark, sf)
    return lh.current_order_items, lh.current_orders, lh.pipeline_dim_products


@register("report_scd2_top10_30d", _top_sql(
    _sales_sql(_CUR_ITEMS, _CUR_ORDERS, _window_30d()), "pipeline_dim_products", True))
def report_scd2_top10_30d(spark, sf):
    items, orders, dims = _scd_inputs(spark, sf)
    return R.top_products(items, orders, dims, R.rolling_30d(AS_OF), with_avg_price=True)


@register("report_scd2_category_30d", _category_sql(
    _sales_sql(_CUR_ITEMS, _CUR_ORDERS, _window_30d()), "pipeline_dim_products", True))
def report_scd2_category_30d(spark, sf):
    items, orders, dims = _scd_inputs(spark, sf)
    return R.category_sales(items, orders, dims, R.rolling_30d(AS_OF), with_avg_price=True)


@register("report_scd2_top10_prev_month", _top_sql(
    _sales_sql(_CUR_ITEMS, _CUR_ORDERS, _prev_month()), "pipeline_dim_products", True))
def report_scd2_top10_prev_month(spark, sf):
    items, orders, dims = _scd_inputs(spark, sf)
    return R.top_products(items, orders, dims, R.previous_calendar_month(AS_OF),
                          with_avg_price=True)


@register("report_scd2_category_prev_month", _category_sql(
    _sales_sql(_CUR_ITEMS, _CUR_ORDERS, _prev_month()), "pipeline_dim_products", True))
def report_scd2_category_prev_month(spark, sf):
    """The one report that reads the current versions of real history tables."""
    lh = lake(spark, sf)
    items, orders, dims = (R.current_only(lh.history_order_items), R.current_only(lh.history_orders),
                           lh.pipeline_dim_products)
    return R.category_sales(items, orders, dims, R.previous_calendar_month(AS_OF),
                            with_avg_price=True)


@register("report_top1_delivered_30d", _top_sql(
    _sales_sql(_CUR_ITEMS, _CUR_ORDERS, _window_30d(), "i.item_status = 'Delivered'"),
    "pipeline_dim_products", True, top=1))
def report_top1_delivered_30d(spark, sf):
    items, orders, dims = _scd_inputs(spark, sf)
    return R.top_delivered(items, orders, dims, R.rolling_30d(AS_OF))


@register("report_top1_delivered_30d_joined", f"""
    SELECT p.product_sku, p.product_name, p.category, CAST(sum(i.quantity) AS BIGINT) AS total_quantity_sold,
           count(DISTINCT i.order_id) AS number_of_orders,
           CAST(sum(CAST(i.quantity AS DECIMAL(12,0)) * CAST(i.unit_price AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
           {O.avg_cents_half_up(f"sum({O.cents('i.unit_price')})", "count(i.unit_price)")} AS avg_unit_price
    FROM h_items i JOIN h_orders o ON i.order_id = o.order_id AND o.__CURRENT
    JOIN pipeline_dim_products p ON i.product_sku = p.product_sku
    WHERE i.__CURRENT AND {_window_30d()} AND o.order_status != 'Cancelled' AND i.item_status = 'Delivered'
    GROUP BY p.product_sku, p.product_name, p.category
    ORDER BY total_quantity_sold DESC, p.product_sku LIMIT 1""")
def report_top1_delivered_30d_joined(spark, sf):
    items, orders, dims = _scd_inputs(spark, sf)
    return R.top_products_joined(items, orders, dims, R.rolling_30d(AS_OF))


# --------------------------------------------------------------------------
# Version history
# --------------------------------------------------------------------------
@register("scd2_events", "SELECT * FROM h_events")
def scd2_events(spark, sf):
    return lake(spark, sf).history_events


@register("scd2_orders", "SELECT * FROM h_orders")
def scd2_orders(spark, sf):
    return lake(spark, sf).history_orders


@register("scd2_order_items", "SELECT * FROM h_items")
def scd2_order_items(spark, sf):
    return lake(spark, sf).history_order_items


_CUR_ORDER_COLS = ["order_id", "customer_id", "order_date", "order_status", "total_amount",
                   "updated_at"]
_CUR_ITEM_COLS = ["order_item_id", "order_id", "product_sku", "quantity", "unit_price",
                  "item_status", "updated_at"]


@register("scd2_current_orders", f"""
    SELECT {', '.join(_CUR_ORDER_COLS)} FROM h_orders WHERE __CURRENT""")
def scd2_current_orders(spark, sf):
    return lake(spark, sf).current_orders.select(*_CUR_ORDER_COLS)


@register("scd2_current_items", f"""
    SELECT {', '.join(_CUR_ITEM_COLS)} FROM h_items WHERE __CURRENT""")
def scd2_current_items(spark, sf):
    return lake(spark, sf).current_order_items.select(*_CUR_ITEM_COLS)


@register("scd2_current_join", """
    SELECT o.order_id, o.order_status, o.order_date, i.order_item_id, i.product_sku,
           i.item_status, i.quantity
    FROM h_orders o JOIN h_items i ON o.order_id = i.order_id AND o.__CURRENT AND i.__CURRENT""")
def scd2_current_join(spark, sf):
    lh = lake(spark, sf)
    orders = lh.current_orders.select("order_id", "order_status", "order_date")
    items = lh.current_order_items.select("order_id", "order_item_id", "product_sku", "item_status", "quantity")
    return orders.join(items, "order_id")


@register("scd2_order_history", """
    SELECT order_id, order_status, total_amount, __START_AT, __END_AT, __CURRENT,
           CASE WHEN __CURRENT THEN 'Current Version' ELSE 'Historical Version' END AS version_type
    FROM h_orders""")
def scd2_order_history(spark, sf):
    return H.version_history(lake(spark, sf).history_orders, "order_id",
                             ["order_id", "order_status", "total_amount"])


@register("scd2_item_history", """
    SELECT order_item_id, item_status, quantity, unit_price, __START_AT AS status_changed_at,
           __END_AT AS status_valid_until, __CURRENT AS is_current
    FROM h_items""")
def scd2_item_history(spark, sf):
    return H.change_log(lake(spark, sf).history_order_items, "order_item_id",
                        ["order_item_id", "item_status", "quantity", "unit_price"])


# Single-key lookups: the key filter reaches the feed's scan, so no sampling
# job plans a split (rows_per_chunk=0): one key's rows are one window group.
LOOKUP_ORDER = 7


@register("scd2_order_lookup", f"""
    SELECT order_id, order_status, total_amount, __START_AT, __END_AT, __CURRENT,
           CASE WHEN __CURRENT THEN 'Current Version' ELSE 'Historical Version' END AS version_type
    FROM h_orders WHERE order_id = {LOOKUP_ORDER} ORDER BY __START_AT""")
def scd2_order_lookup(spark, sf):
    lh = lake(spark, sf, scd_options={"rows_per_chunk": 0})
    return H.version_history(lh.history_orders, "order_id",
                             ["order_id", "order_status", "total_amount"], key_value=LOOKUP_ORDER)


@register("scd2_item_lookup", """
    SELECT order_item_id, item_status, quantity, unit_price, __START_AT AS status_changed_at,
           __END_AT AS status_valid_until, __CURRENT AS is_current
    FROM h_items WHERE order_item_id = (SELECT min(order_item_id) FROM h_items)
    ORDER BY __START_AT""")
def scd2_item_lookup(spark, sf):
    lh = lake(spark, sf, scd_options={"rows_per_chunk": 0})
    # the history's least key: rows without a sequence have no version
    first = lh.stage_fact_order_items.where("updated_at is not null").agg(F.min("order_item_id")).first()[0]
    found = H.change_log(lh.history_order_items, "order_item_id",
                         ["order_item_id", "item_status", "quantity", "unit_price"], key_value=first)
    return found if first is not None else found.where(F.lit(False))


@register("scd2_orders_except", """
    SELECT order_id, order_date, order_status, total_amount, updated_at, order_year, order_month,
           order_day, __START_AT, __END_AT, __CURRENT FROM h_orders""")
def scd2_orders_except(spark, sf):
    from ledgerline.operators.scd2 import apply_scd2
    return apply_scd2(lake(spark, sf).stage_fact_orders, ["order_id"], "updated_at",
                      ["order_status", "total_amount"], except_columns=["customer_id"])


@register("scd2_as_of", f"""
    SELECT order_id, customer_id, order_status, total_amount, __START_AT AS valid_from,
           __END_AT AS valid_to
    FROM h_orders
    WHERE __START_AT <= {O._ts(O.ORDERS_AS_OF)}
      AND (__END_AT > {O._ts(O.ORDERS_AS_OF)} OR __END_AT IS NULL)""")
def scd2_as_of(spark, sf):
    return H.as_of(lake(spark, sf).history_orders, O.ORDERS_AS_OF,
                   ["order_id", "customer_id", "order_status", "total_amount"])


@register("scd2_events_as_of", f"""
    SELECT user_id, event_type, value, __START_AT AS valid_from, __END_AT AS valid_to
    FROM h_events
    WHERE __START_AT <= {O._ts(O.EVENTS_AS_OF)}
      AND (__END_AT > {O._ts(O.EVENTS_AS_OF)} OR __END_AT IS NULL)""")
def scd2_events_as_of(spark, sf):
    return H.as_of(lake(spark, sf).history_events, O.EVENTS_AS_OF,
                   ["user_id", "event_type", "value"])


# --------------------------------------------------------------------------
# Incremental and streaming history (late rows placed by sequence)
# --------------------------------------------------------------------------
ALL_FILES = 2**31 - 1


def _stream(spark, feed: DataFrame, name: str, keys, seq, tracked, batches: int = 3):
    """Write ``feed`` as ``batches`` arrival folders and stream them into history, one micro-batch each.

    Rows are dealt to the folders by a hash of the whole row (deterministic, no
    shuffle), so a key's changes arrive out of sequence order across micro-batches.
    """
    from ledgerline.session import scratch_path
    from ledgerline.streaming import ChangeLogHistory, stream_history
    root = scratch_path(spark, f"stream-{name}")
    arrival = F.pmod(F.xxhash64(*feed.columns), F.lit(batches))
    feed.withColumn("arrival", arrival).write.partitionBy("arrival").parquet(f"{root}/source")
    target = ChangeLogHistory(spark, f"{root}/target", keys, seq, tracked, buckets=16)
    for n in target.children(f"{root}/source", "arrival"):  # a folder that got no row was not written
        stream_history(spark, f"{root}/source/arrival={n}", feed.schema, target.root, keys, seq, tracked,
                       files_per_batch=ALL_FILES, buckets=16, checkpoint=f"{root}/checkpoint-{n}")
    return target.history()


@register("scd2_stream_events", "SELECT * FROM h_events")
def scd2_stream_events(spark, sf):
    return _stream(spark, lake(spark, sf).model.events(), "events", ["user_id"], "ts",
                   ["event_type"])


@register("scd2_stream_orders", "SELECT * FROM h_orders")
def scd2_stream_orders(spark, sf):
    from ledgerline.plans.lakehouse import ORDER_TRACKED
    return _stream(spark, lake(spark, sf).stage_fact_orders, "orders", ["order_id"],
                   "updated_at", list(ORDER_TRACKED))


@register("scd2_stream_order_items", "SELECT * FROM h_items")
def scd2_stream_order_items(spark, sf):
    from ledgerline.plans.lakehouse import ITEM_TRACKED
    return _stream(spark, lake(spark, sf).stage_fact_order_items, "items", ["order_item_id"],
                   "updated_at", list(ITEM_TRACKED))


LATE_CUT = O.dt.datetime(1998, 1, 1)


@register("scd2_late_arrivals", "SELECT * FROM h_items")
def scd2_late_arrivals(spark, sf):
    """Items history built in two arrivals: changes from 1998 on first, then
    every older change, late.  Equals the history built in one pass."""
    from ledgerline.plans.lakehouse import ITEM_TRACKED
    from ledgerline.session import scratch_path
    from ledgerline.streaming import ChangeLogHistory
    feed = lake(spark, sf).stage_fact_order_items
    cut = H.instant_literal(LATE_CUT, feed.schema["updated_at"].dataType)
    target = ChangeLogHistory(spark, scratch_path(spark, "late-items"), ["order_item_id"],
                              "updated_at", list(ITEM_TRACKED), buckets=16)
    target.apply_batch(feed.where(F.col("updated_at") >= cut), 0)
    target.apply_batch(feed.where(F.col("updated_at") < cut), 1)
    return target.history()


@register("scd2_stream_compacted", "SELECT * FROM h_items")
def scd2_stream_compacted(spark, sf):
    """Items history from two batches, a compaction of log and history, and a later batch of late rows."""
    from ledgerline.plans.lakehouse import ITEM_TRACKED
    from ledgerline.session import scratch_path
    from ledgerline.streaming import ChangeLogHistory
    feed = lake(spark, sf).stage_fact_order_items
    target = ChangeLogHistory(spark, scratch_path(spark, "compacted-items"), ["order_item_id"],
                              "updated_at", list(ITEM_TRACKED), buckets=16)
    status = F.coalesce("item_status", F.lit(""))
    target.apply_batch(feed.where(status == "Initial"), 0)
    target.apply_batch(feed.where(status == "Delivered"), 1)
    target.compact_log(1)
    target.compact_history(1)
    target.apply_batch(feed.where(~status.isin("Initial", "Delivered")), 2)
    return target.history()


# --------------------------------------------------------------------------
# Layers through catalog tables, stored histories, partition refresh
# --------------------------------------------------------------------------
def _layers(spark, sf, **kw):
    from ledgerline.plans.tables import Layers
    return Layers.build(OrderModel(spark, sf), **kw)


@register("report_top10_30d_catalog", ORACLE["report_top10_30d"])
def report_top10_30d_catalog(spark, sf):
    """Bronze, silver and gold written as catalog tables, each from the one before, and the report over gold."""
    t = _layers(spark, sf, histories=False).table
    return R.top_products(t("fact_order_items"), t("fact_orders"), t("dim_products"), R.rolling_30d(AS_OF))


@register("scd2_current_join_stored", ORACLE["scd2_current_join"])
def scd2_current_join_stored(spark, sf):
    """Current orders and items from histories stored by validity and bucketed on the order."""
    from ledgerline.plans import tables as TB
    layers = _layers(spark, sf)
    orders = layers.table("history_orders").select("order_id", "order_status", "order_date", H.START_AT, H.END_AT, H.CURRENT, TB.END_MONTH)
    items = layers.table("history_order_items").drop("updated_at", "unit_price")
    return TB.stored_current_join(orders, items, "order_id")


@register("scd2_as_of_stored", ORACLE["scd2_as_of"])
def scd2_as_of_stored(spark, sf):
    """Point in time over a stored history: partitions that ended earlier are left out."""
    from ledgerline.plans import tables as TB
    db = TB.create_database(spark)
    TB.write_history(lake(spark, sf).history_orders, f"{db}.history_orders", ["order_id"], 8)
    return TB.stored_as_of(spark.table(f"{db}.history_orders"), O.ORDERS_AS_OF,
                           ["order_id", "customer_id", "order_status", "total_amount"])


@register("sink_replace_schema", """
    SELECT order_item_id, order_id, CAST(quantity AS DOUBLE) AS quantity, unit_price, item_status,
           item_status = 'Cancelled' AS cancelled FROM fact_items""")
def sink_replace_schema(spark, sf):
    """A table replaced by one with a column added, two dropped and one retyped, read through its name."""
    from ledgerline.plans import tables as TB
    db = TB.create_database(spark)
    TB.replace_table(lake(spark, sf).fact_order_items, f"{db}.items")
    old = spark.table(f"{db}.items")
    TB.replace_table(old.select("order_item_id", "order_id", F.col("quantity").cast("double").alias("quantity"),
                                "unit_price", "item_status", (F.col("item_status") == "Cancelled").alias("cancelled")),
                     f"{db}.items")
    return spark.table(f"{db}.items")


@register("gold_fact_orders_refreshed", "SELECT * FROM fact_orders")
def gold_fact_orders_refreshed(spark, sf):
    """Order facts of all arrival folders but the newest, which a partition refresh then takes in."""
    from ledgerline.plans import tables as TB
    from ledgerline.session import scratch_path
    from ledgerline.sources.files import write_table
    root = scratch_path(spark, "refreshed-orders")
    orders = lake(spark, sf).bronze_orders
    write_table(orders, f"{root}/raw", partition_by=TB.ARRIVAL)
    raw = spark.read.parquet(f"{root}/raw")
    year, month = divmod(raw.agg(F.max(F.col("year") * 100 + F.col("month"))).first()[0], 100)
    early = raw.where((F.col("year") != year) | (F.col("month") != month))
    write_table(TB.order_facts(early), f"{root}/facts", partition_by=S.ORDER_PARTITIONS)
    write_table(TB.dependencies(early), f"{root}/depends", partition_by=TB.ARRIVAL)
    TB.refresh_orders(raw, year, month, root)
    return spark.read.parquet(f"{root}/facts").select(*TB.order_facts(raw).columns)


# --------------------------------------------------------------------------
# Sources and sinks (round trips through files in the shared folder)
# --------------------------------------------------------------------------
@register("scan_csv_inferred_file", """
    SELECT CAST(customer_id AS INTEGER) AS customer_id, first_name, CAST(last_name AS INTEGER) AS last_name, email,
           zipcode, created_at, deleted_at FROM customers_raw""")
def scan_csv_inferred_file(spark, sf):
    """Customers as one CSV file, every type inferred."""
    from ledgerline.session import scratch_path
    from ledgerline.sources import reconcile
    path = scratch_path(spark, "csv-inferred")
    lake(spark, sf).bronze_customers.repartition(1).write.option("header", True).csv(path)
    return reconcile.scan(spark, path).rows


@register("scan_csv_reconciled_folder", """
    SELECT CAST(order_id AS INTEGER) AS order_id, CAST(customer_id AS INTEGER) AS customer_id, ordered_at, order_status,
           subtotal_amount, tax_amount, shipping_fee, total_amount, updated_at FROM orders_raw""")
def scan_csv_reconciled_folder(spark, sf):
    """Orders in files of two layouts, columns in reverse order in one, types inferred per file and widened."""
    from ledgerline.session import scratch_path
    from ledgerline.sources import reconcile
    path = scratch_path(spark, "csv-layouts")
    orders = lake(spark, sf).bronze_orders.drop("year", "month")
    done = F.coalesce(F.col("order_status") == "Complete", F.lit(False))
    orders.where(done).write.option("header", True).csv(path)
    orders.where(~done).select(*reversed(orders.columns)).write.mode("append").option("header", True).csv(path)
    return reconcile.scan(spark, path).rows.select(*orders.columns)


@register("scan_csv_roundtrip", "SELECT * FROM customers_raw")
def scan_csv_roundtrip(spark, sf):
    """Customers written as CSV with a header, scanned back with the schema."""
    from ledgerline import schemas
    from ledgerline.session import scratch_path
    from ledgerline.sources.files import read_csv, write_table
    path = scratch_path(spark, "csv-customers")
    write_table(lake(spark, sf).bronze_customers, path, fmt="csv")
    return read_csv(spark, path, schema=schemas.CUSTOMERS)


@register("scan_partitioned_csv", "SELECT * FROM orders_raw")
def scan_partitioned_csv(spark, sf):
    """Orders written to year=/month= CSV folders, scanned back: the folder
    values return as int columns."""
    from ledgerline import schemas
    from ledgerline.session import scratch_path
    from ledgerline.sources.files import read_csv, write_table
    path = scratch_path(spark, "csv-orders")
    write_table(lake(spark, sf).bronze_orders, path, fmt="csv",
                partition_by=schemas.ARRIVAL_PARTITIONS)
    return read_csv(spark, path, schema=schemas.ORDERS,
                    partition_columns=schemas.ARRIVAL_PARTITIONS)


@register("sink_overwrite_roundtrip", "SELECT * FROM fact_items")
def sink_overwrite_roundtrip(spark, sf):
    """An overwrite replaces what the target held before."""
    from ledgerline.session import scratch_path
    from ledgerline.sources.files import read_table, write_table
    items = lake(spark, sf).fact_order_items
    path = scratch_path(spark, "fact-items")
    write_table(items.where(F.col("item_status") == "Cancelled"), path)
    write_table(items, path)
    return read_table(spark, path)


@register("sink_partitioned_roundtrip", "SELECT * FROM fact_orders")
def sink_partitioned_roundtrip(spark, sf):
    """Order facts written partitioned by order_year/month/day and read back."""
    from ledgerline.operators.silver import ORDER_PARTITIONS
    from ledgerline.session import scratch_path
    from ledgerline.sources.files import read_table, write_table
    path = scratch_path(spark, "fact-orders")
    write_table(lake(spark, sf).fact_orders, path, partition_by=ORDER_PARTITIONS)
    return read_table(spark, path)


# --------------------------------------------------------------------------
# The same reports as Spark SQL over views of the layers
# --------------------------------------------------------------------------
def _sql_report(spark, sf, report, **kw):
    from ledgerline.plans.sql_reports import HISTORY, PLAIN, register_views, run_report
    tables = HISTORY if kw.get("current_only") else PLAIN
    register_views(lake(spark, sf), list(tables.values()))
    return run_report(spark, report, AS_OF, **kw)


@register("report_top10_30d_sql", ORACLE["report_top10_30d"])
def report_top10_30d_sql(spark, sf):
    return _sql_report(spark, sf, "top")


@register("report_category_prev_month_sql", ORACLE["report_category_prev_month"])
def report_category_prev_month_sql(spark, sf):
    return _sql_report(spark, sf, "category", window="month")


@register("report_scd2_top10_prev_month_sql", ORACLE["report_scd2_top10_prev_month"])
def report_scd2_top10_prev_month_sql(spark, sf):
    return _sql_report(spark, sf, "top", window="month", current_only=True,
                       with_avg_price=True)


@register("report_scd2_category_30d_sql", ORACLE["report_scd2_category_30d"])
def report_scd2_category_30d_sql(spark, sf):
    return _sql_report(spark, sf, "category", current_only=True, with_avg_price=True)


@register("report_top1_delivered_30d_sql", ORACLE["report_top1_delivered_30d"])
def report_top1_delivered_30d_sql(spark, sf):
    return _sql_report(spark, sf, "top", top=1, current_only=True, with_avg_price=True,
                       sold_status="Delivered")
