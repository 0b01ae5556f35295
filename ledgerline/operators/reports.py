"""Reports: the most sold products and sales by category.

Plan shape for every report (Catalyst does the rest):

1. filter orders to the window (rolling 30 days, or one calendar month given as
   literals so partitioned tables prune), drop cancelled orders;
2. join items on ``order_id`` (AQE turns it into a broadcast join at run time
   when the filtered orders are small, and splits skewed order ids otherwise);
3. aggregate per SKU *before* touching the product dimension (eager
   aggregation: the dimension join sees one row per SKU, not per item);
4. join the dimension and either take the top k or aggregate per category.

Money is summed as exact cents (``decimal(18,2)``) and returned as double, so
results do not depend on row order; averages round HALF_UP on exact values.
``SUM(number_of_orders)`` at category level counts an order once per product,
and the category average is a mean of per-product means: both are the
reports' definitions and are kept.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.columns import line_value, money
from ledgerline.functions.constants import CANCELLED, DELIVERED, CURRENT
from ledgerline.functions.dates import month_key, previous_month, rolling_window_predicate

DEFAULT_TOP = 10


def rolling_30d(as_of: dt.date | str | None, days: int = 30) -> Column:
    """Order filter: ``order_date`` in ``[as_of - days, as_of)``."""
    return rolling_window_predicate("order_date", as_of, days,
                                    "order_year", "order_month")


def previous_calendar_month(as_of: dt.date | str | None) -> Column:
    """Order filter: the calendar month before ``as_of`` (partition columns)."""
    year, month = previous_month(as_of)
    return (F.col("order_year") == year) & (F.col("order_month") == month)


def current_only(df: DataFrame) -> DataFrame:
    """Current versions of a history table (``__CURRENT = TRUE``)."""
    return df.where(F.col(CURRENT))


def _sold_items(items: DataFrame, orders: DataFrame, order_filter: Column,
                item_filter: Column) -> DataFrame:
    o = orders.where(order_filter & (F.col("order_status") != CANCELLED)).select("order_id")
    i = items.where(item_filter).select("order_id", "product_sku", "quantity", "unit_price")
    return i.join(o, "order_id")


def product_sales(items: DataFrame, orders: DataFrame, order_filter: Column,
                  item_filter: Column | None = None) -> DataFrame:
    """Per SKU: quantity, distinct orders, exact revenue and price sums.

    Columns: product_sku, quantity (bigint), orders (bigint),
    revenue (decimal), price_sum (decimal), price_count (bigint).
    """
    if item_filter is None:
        item_filter = F.col("item_status") != CANCELLED
    sold = _sold_items(items, orders, order_filter, item_filter)
    return sold.groupBy("product_sku").agg(
        F.sum("quantity").cast(T.LongType()).alias("quantity"),
        F.countDistinct("order_id").alias("orders"),
        F.sum(line_value()).alias("revenue"),
        F.sum(money("unit_price")).alias("price_sum"),
        F.count("unit_price").alias("price_count"),
    )


def top_products(items: DataFrame, orders: DataFrame, products: DataFrame,
                 order_filter: Column, top: int = DEFAULT_TOP,
                 with_avg_price: bool = False,
                 item_filter: Column | None = None) -> DataFrame:
    """Top ``top`` SKUs by quantity; ties broken by SKU."""
    s = product_sales(items, orders, order_filter, item_filter)
    p = products.select("product_sku", "product_name", "category")
    cols = [
        "product_sku", "product_name", "category",
        F.col("quantity").alias("total_quantity_sold"),
        F.col("orders").alias("number_of_orders"),
        F.col("revenue").cast(T.DoubleType()).alias("total_revenue"),
    ]
    if with_avg_price:
        cols.append(F.round(F.col("price_sum") / F.col("price_count"), 2)
                    .cast(T.DoubleType()).alias("avg_unit_price"))
    out = s.join(p, "product_sku").select(*cols)
    return out.orderBy(F.col("total_quantity_sold").desc(), F.col("product_sku")).limit(top)


def category_sales(items: DataFrame, orders: DataFrame, products: DataFrame,
                   order_filter: Column, with_avg_price: bool = False) -> DataFrame:
    """Per category: quantity, distinct products, summed per-product order
    counts and revenue; optionally the mean of per-product mean prices.

    Plain reports order by quantity; the history reports (``with_avg_price``)
    list ``unique_products`` first and order by revenue.
    """
    s = product_sales(items, orders, order_filter)
    if with_avg_price:
        s = s.withColumn("avg_price", F.col("price_sum") / F.col("price_count"))
    joined = s.join(products.select("product_sku", "category"), "product_sku")
    qty = F.sum("quantity").cast(T.LongType()).alias("total_quantity_sold")
    n_orders = F.sum("orders").cast(T.LongType()).alias("number_of_orders")
    revenue = F.sum("revenue").cast(T.DoubleType()).alias("total_revenue")
    distinct = F.countDistinct("product_sku")
    if with_avg_price:
        out = joined.groupBy("category").agg(
            distinct.alias("unique_products"), qty, n_orders, revenue,
            F.round(F.avg("avg_price"), 2).cast(T.DoubleType()).alias("avg_unit_price"))
        return out.orderBy(F.col("total_revenue").desc(), "category")
    out = joined.groupBy("category").agg(qty, distinct.alias("distinct_products"),
                                         n_orders, revenue)
    return out.orderBy(F.col("total_quantity_sold").desc(), "category")


def top_delivered(items: DataFrame, orders: DataFrame, products: DataFrame,
                  order_filter: Column, top: int = 1) -> DataFrame:
    """Most sold product counting delivered items only."""
    return top_products(items, orders, products, order_filter, top=top,
                        with_avg_price=True,
                        item_filter=F.col("item_status") == DELIVERED)


def top_products_joined(items: DataFrame, orders: DataFrame, products: DataFrame,
                        order_filter: Column, top: int = 1, item_filter: Column | None = None) -> DataFrame:
    """Most sold products by the three-way join first, the aggregate above it.

    Every dimension row of a SKU joins: rows equal in name and category count its
    sales again, others are groups of their own, whereas ``top_products`` sums each
    SKU before it looks up the dimension.  On a dimension with one row per SKU both agree.
    """
    if item_filter is None:
        item_filter = F.col("item_status") == DELIVERED
    sold = _sold_items(items, orders, order_filter, item_filter)
    joined = sold.join(products.select("product_sku", "product_name", "category"), "product_sku")
    out = joined.groupBy("product_sku", "product_name", "category").agg(
        F.sum("quantity").cast(T.LongType()).alias("total_quantity_sold"),
        F.countDistinct("order_id").alias("number_of_orders"),
        F.sum(line_value()).cast(T.DoubleType()).alias("total_revenue"),
        F.round(F.sum(money("unit_price")) / F.count("unit_price"), 2).cast(T.DoubleType()).alias("avg_unit_price"))
    return out.orderBy(F.col("total_quantity_sold").desc(), "product_sku", "product_name", "category").limit(top)


def orders_since(orders: DataFrame, since: dt.date | str,
                 columns=("order_id", "order_status", "total_amount")) -> DataFrame:
    """Orders with ``order_date >= since`` (a history table: add current_only).

    On a table with order_year/order_month the implied month bound is stated
    too, so a partitioned scan skips earlier months.
    """
    if isinstance(since, str):
        since = dt.date.fromisoformat(since)
    recent = F.col("order_date") >= F.lit(since)
    if {"order_year", "order_month"} <= set(orders.columns):
        recent = recent & (month_key("order_year", "order_month") >= since.year * 100 + since.month)
    return orders.where(recent).select(*columns)
