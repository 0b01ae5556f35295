"""Gold layer: dimensions and facts (plain, full-refresh tables), the staging
transforms that feed version history, and the rule-checked pipeline dims."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import customer_name, unit_price
from ledgerline.operators.quality import CUSTOMER_RULES, PRODUCT_RULES, expect_or_drop

FACT_ORDER_COLUMNS = ("order_id", "customer_id", "order_date", "order_status",
                      "total_amount", "updated_at", "order_year", "order_month",
                      "order_day")
FACT_ITEM_COLUMNS = ("order_item_id", "order_id", "product_sku", "quantity",
                     "unit_price", "item_status", "updated_at")


def dim_customers(silver_customers: DataFrame) -> DataFrame:
    """Active customers with ``last, first`` names."""
    return silver_customers.where(F.col("active")).select(
        "customer_id", customer_name().alias("customer_name"), "email", "created_at")


def dim_products(silver_products: DataFrame) -> DataFrame:
    """Active products; the active filter makes the SKU unique."""
    return silver_products.where(F.col("active")).select(
        "product_sku", "product_name", "category", "price")


def fact_orders(orders_active: DataFrame) -> DataFrame:
    """Order facts from the active (not cancelled) silver orders."""
    return orders_active.select(
        "order_id", "customer_id",
        F.to_date("ordered_at").alias("order_date"),
        "order_status", "total_amount", "updated_at",
        "order_year", "order_month", "order_day")


def fact_order_items(silver_items: DataFrame) -> DataFrame:
    """Item facts with ``unit_price = round(line_amount / quantity, 2)``."""
    return silver_items.select(
        "order_item_id", "order_id", "product_sku", "quantity",
        unit_price().alias("unit_price"), "item_status", "updated_at")


# The pipeline's staging views apply the same transforms to the change feed.
stage_fact_orders = fact_orders
stage_fact_order_items = fact_order_items


def pipeline_dim_customers(silver_customers: DataFrame) -> DataFrame:
    """Current-state customer dimension with its quality rules applied."""
    return expect_or_drop(dim_customers(silver_customers), CUSTOMER_RULES)


def pipeline_dim_products(silver_products: DataFrame) -> DataFrame:
    """Current-state product dimension with its quality rules applied."""
    return expect_or_drop(dim_products(silver_products), PRODUCT_RULES)
