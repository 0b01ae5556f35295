"""Explicit schemas of the raw order model (what the CSV sources hold).

Readers use them instead of inference: inference costs an extra pass over the
input and streams need a schema anyway.
"""

from pyspark.sql import types as T

STATUS = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("order", T.IntegerType()),
])

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("zipcode", T.IntegerType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("deleted_at", T.TimestampNTZType()),
])

PRODUCTS = T.StructType([
    T.StructField("product_sku", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("stock_quantity", T.IntegerType()),
    T.StructField("created_at", T.DateType()),
    T.StructField("deleted_at", T.DateType()),
])

ORDERS = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("ordered_at", T.TimestampNTZType()),
    T.StructField("order_status", T.StringType()),
    T.StructField("subtotal_amount", T.DoubleType()),
    T.StructField("tax_amount", T.DoubleType()),
    T.StructField("shipping_fee", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

ORDER_ITEMS = T.StructType([
    T.StructField("order_item_id", T.LongType()),
    T.StructField("order_id", T.LongType()),
    T.StructField("product_sku", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("discount_applied", T.DoubleType()),
    T.StructField("line_amount", T.DoubleType()),
    T.StructField("item_status", T.StringType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

# Transaction files sit in Hive-style year=/month= folders (arrival month).
ARRIVAL_PARTITIONS = ("year", "month")

BY_NAME = {
    "status": STATUS,
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
}
