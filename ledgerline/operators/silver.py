"""Silver layer: typed, flagged, split bronze tables (narrow transforms)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import active_flag, discount_flag, to_utc_columns
from ledgerline.functions.constants import CANCELLED

ORDER_PARTITIONS = ("order_year", "order_month", "order_day")


def silver_status(status: DataFrame) -> DataFrame:
    """Pass-through copy of the status master."""
    return status


def with_active_flag(df: DataFrame, deleted_col: str = "deleted_at") -> DataFrame:
    """Replace the deletion time by an ``active`` boolean."""
    return df.withColumn("active", active_flag(deleted_col)).drop(deleted_col)


def silver_products(products: DataFrame) -> DataFrame:
    return with_active_flag(products)


def silver_customers(customers: DataFrame) -> DataFrame:
    return with_active_flag(customers)


def silver_orders(orders: DataFrame, source_zone: str = "UTC") -> DataFrame:
    """Timestamps to UTC, plus calendar columns of ``ordered_at``.

    ``order_year/month/day`` follow the order time, not the arrival folder:
    an order placed on 30 May that arrives in the June folder is in month 5.
    """
    df = to_utc_columns(orders, source_zone)
    ts = F.col("ordered_at")
    return df.withColumns({
        "order_year": F.year(ts),
        "order_month": F.month(ts),
        "order_day": F.dayofmonth(ts),
    })


def active_orders(silver: DataFrame) -> DataFrame:
    """Orders not cancelled.  A NULL status is in neither split."""
    return silver.where(F.col("order_status") != CANCELLED)


def inactive_orders(silver: DataFrame) -> DataFrame:
    return silver.where(F.col("order_status") == CANCELLED)


def silver_order_items(items: DataFrame, source_zone: str = "UTC") -> DataFrame:
    """Timestamps to UTC; ``discount_applied`` becomes ``discounted``."""
    df = to_utc_columns(items, source_zone)
    return df.withColumn("discounted", discount_flag("discount_applied")) \
             .drop("discount_applied")
