"""The order model over the driver's TPC-H-style tables.

The source system ships CSV files for customers, products, status, orders and
order items.  Here the same raw shapes are derived, column by column, from the
``customer``, ``part``, ``orders``, ``lineitem`` and ``events`` tables, so every
layer runs on data that grows with the scale factor.  All mappings are narrow
projections (no shuffle) except the order change feed, which aggregates line
items per (order, ship date).

Mapping rules (mirrored by the DuckDB oracle):

* customers  <- customer: id = c_custkey; first_name 'Customer'; last_name is
  the text after '#'; email NULL when id % 50 = 0, without '@' when
  id % 50 = 1; deleted when c_acctbal < 0.
* products   <- part: sku = p_partkey as text, category = p_type; deleted when
  p_size > 45.  Like real raw data some prices are bad (negative when
  key % 40 = 0, NULL when key % 40 = 1): the plain gold layer keeps them, the
  rule-checked pipeline dimension drops them.
* orders     <- orders: F -> Complete, P -> Cancelled, O -> Initial when the
  priority is 5-LOW else In-Progress; ordered_at = updated_at = o_orderdate.
* order_items <- lineitem: one item per line row, id = orderkey * 100 +
  linenumber (several rows per id form the item change feed); returnflag
  R -> Cancelled, N -> Initial, A with linestatus O -> Shipped, else
  Delivered; updated_at = l_shipdate.
* order change feed: per order an Initial row at the order date, then one row
  per distinct ship date of its lines (In-Progress while a line shipped that
  day is still open, else Complete; Cancelled for status P orders).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.constants import STATUS_MASTER

CREATED_BASE = dt.date(1994, 1, 1)
DELETED_AT = dt.date(1999, 1, 1)
ITEM_ID_FACTOR = 100


class OrderModel:
    """Raw order-model tables derived lazily from one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    # -- driver tables ---------------------------------------------------
    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- master data -----------------------------------------------------
    def customers(self) -> DataFrame:
        c = self.table("customer")
        key = F.col("c_custkey")
        last = F.substring_index(F.col("c_name"), "#", -1)
        return c.select(
            key.alias("customer_id"),
            F.lit("Customer").alias("first_name"),
            last.alias("last_name"),
            F.when(key % 50 == 0, F.lit(None).cast("string"))
             .when(key % 50 == 1, F.concat(F.lit("customer"), last, F.lit(".example.com")))
             .otherwise(F.concat(F.lit("customer"), last, F.lit("@example.com")))
             .alias("email"),
            (F.col("c_nationkey") * 1000 + (key % 1000)).cast("int").alias("zipcode"),
            F.date_add(F.lit(CREATED_BASE), (key % 365).cast("int"))
             .cast(T.TimestampNTZType()).alias("created_at"),
            F.when(F.col("c_acctbal") < 0, F.lit(DELETED_AT).cast(T.TimestampNTZType()))
             .alias("deleted_at"),
        )

    def products(self) -> DataFrame:
        p = self.table("part")
        key = F.col("p_partkey")
        price = (F.when(key % 40 == 0, -F.col("p_retailprice"))
                 .when(key % 40 == 1, F.lit(None).cast("double"))
                 .otherwise(F.col("p_retailprice")))
        return p.select(
            key.cast("string").alias("product_sku"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            price.alias("price"),
            (F.col("p_size") * 10).alias("stock_quantity"),
            F.lit(CREATED_BASE).alias("created_at"),
            F.when(F.col("p_size") > 45, F.lit(DELETED_AT)).alias("deleted_at"),
        )

    def status(self) -> DataFrame:
        """Status master: every status the transactions use, with its code.

        Derived from the data (distinct over orders and items) rather than
        typed in, so it always covers what the facts contain.
        """
        codes = F.create_map(*[x for (kind, name, code) in STATUS_MASTER
                               for x in (F.lit(f"{kind}|{name}"), F.lit(code))])
        used = (self.orders().select(F.lit("order").alias("type"),
                                     F.col("order_status").alias("status"))
                .union(self.order_items().select(F.lit("item").alias("type"),
                                                 F.col("item_status").alias("status")))
                .distinct())
        return used.select(
            "type", "status",
            codes[F.concat_ws("|", "type", "status")].cast("int").alias("order"))

    # -- transactions ----------------------------------------------------
    @staticmethod
    def _order_status(orderstatus: str, priority: str):
        return (F.when(F.col(orderstatus) == "F", F.lit("Complete"))
                .when(F.col(orderstatus) == "P", F.lit("Cancelled"))
                .when(F.col(priority) == "5-LOW", F.lit("Initial"))
                .otherwise(F.lit("In-Progress")))

    def orders(self) -> DataFrame:
        o = self.table("orders")
        ts = F.col("o_orderdate")
        return o.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            ts.alias("ordered_at"),
            self._order_status("o_orderstatus", "o_orderpriority").alias("order_status"),
            F.col("o_totalprice").alias("subtotal_amount"),
            F.lit(0.0).alias("tax_amount"),
            F.lit(0.0).alias("shipping_fee"),
            F.col("o_totalprice").alias("total_amount"),
            ts.alias("updated_at"),
            F.year(ts).alias("year"),
            F.month(ts).alias("month"),
        )

    def order_items(self) -> DataFrame:
        li = self.table("lineitem")
        return li.select(
            (F.col("l_orderkey") * ITEM_ID_FACTOR + F.col("l_linenumber")).alias("order_item_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").cast("string").alias("product_sku"),
            F.col("l_quantity").cast("int").alias("quantity"),
            (F.col("l_extendedprice") * F.col("l_discount")).alias("discount_applied"),
            F.col("l_extendedprice").alias("line_amount"),
            (F.when(F.col("l_returnflag") == "R", F.lit("Cancelled"))
             .when(F.col("l_returnflag") == "N", F.lit("Initial"))
             .when(F.col("l_linestatus") == "O", F.lit("Shipped"))
             .otherwise(F.lit("Delivered"))).alias("item_status"),
            F.col("l_shipdate").alias("updated_at"),
            F.year("l_shipdate").alias("year"),
            F.month("l_shipdate").alias("month"),
        )

    def item_change_feed(self) -> DataFrame:
        """Item changes keyed by ``order_item_id``, ordered by ``updated_at``."""
        return self.order_items().drop("year", "month")

    def order_change_feed(self) -> DataFrame:
        """Order changes keyed by ``order_id``, ordered by ``updated_at``."""
        o = self.orders().drop("year", "month")
        # lines are shuffled by order once, for the aggregation and the join;
        # an int flag keeps the aggregation hash-based (a string max sorts)
        li = self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"), F.col("l_shipdate").alias("updated_at"),
            (F.col("l_linestatus") == "O").cast("int").alias("open")).repartition("order_id")
        shipped = li.groupBy("order_id", "updated_at").agg(F.max("open").alias("open"))
        later = (shipped.join(o.drop("updated_at"), "order_id")
                 .withColumn("order_status",
                             F.when(F.col("order_status") == "Cancelled", F.lit("Cancelled"))
                             .when(F.col("open") == 1, F.lit("In-Progress"))
                             .otherwise(F.lit("Complete")))
                 .drop("open"))
        first = o.withColumn("order_status", F.lit("Initial"))
        return first.unionByName(later.select(*first.columns))

    def order_feed_keys(self) -> DataFrame:
        """(order_id, updated_at) straight from the scans, one row per order
        and per line item: at least as many rows per order as the change
        feed has, so it can stand in for it when sampling for hot keys."""
        return (self.table("orders").select(F.col("o_orderkey").alias("order_id"),
                                            F.col("o_orderdate").alias("updated_at"))
                .unionByName(self.table("lineitem").select(
                    F.col("l_orderkey").alias("order_id"),
                    F.col("l_shipdate").alias("updated_at"))))

    def events(self) -> DataFrame:
        return self.table("events")
