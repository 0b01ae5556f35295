"""Profiling and verification aggregates (counts per flag, status, month).

Each is one aggregation with map-side partial aggregation; outputs are a
handful of rows whatever the input size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def schema_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, null and non-null counts.

    All counts come from a single pass over ``df``.
    """
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count_if(F.col(f.name).isNull()).alias(f"_n{i}") for i, f in enumerate(fields)]
    counts = df.agg(*aggs)
    entries = F.explode(F.array(*[
        F.struct(F.lit(i + 1).alias("ordinal"), F.lit(f.name).alias("column_name"),
                 F.lit(f.dataType.simpleString()).alias("data_type"),
                 F.col(f"_n{i}").alias("null_count"))
        for i, f in enumerate(fields)]))
    return counts.select(F.col("_rows"), entries.alias("e")).select(
        "e.ordinal", "e.column_name", "e.data_type", "e.null_count",
        (F.col("_rows") - F.col("e.null_count")).alias("non_null_count"))


def live_counts(df: DataFrame, dataset: str, live: str) -> DataFrame:
    """Total rows and rows meeting ``live`` (a SQL predicate)."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  F.count_if(F.coalesce(F.expr(live), F.lit(False))).alias("active_rows")) \
             .select(F.lit(dataset).alias("dataset"), "total_rows", "active_rows")


def distinct_count(df: DataFrame, column: str, alias: str) -> DataFrame:
    """Exact number of distinct non-null values of ``column``."""
    return df.agg(F.countDistinct(column).alias(alias))


def product_availability(products: DataFrame) -> DataFrame:
    """Products per availability label (Active / Inactive by deletion)."""
    label = F.when(F.col("deleted_at").isNull(), F.lit("Active")).otherwise(F.lit("Inactive"))
    return products.groupBy(label.alias("product_availability")) \
                   .agg(F.count(F.lit(1)).alias("product_count"))


def count_by(df: DataFrame, columns: list[str], alias: str,
             order: bool = False) -> DataFrame:
    out = df.groupBy(*columns).agg(F.count(F.lit(1)).alias(alias))
    return out.orderBy(*columns) if order else out


def status_distribution(fact_orders: DataFrame) -> DataFrame:
    """Orders and exact revenue per status, most frequent first."""
    return (fact_orders.groupBy("order_status")
            .agg(F.count(F.lit(1)).alias("order_count"),
                 F.sum(F.col("total_amount").cast(T.DecimalType(18, 2)))
                  .cast(T.DoubleType()).alias("total_revenue"))
            .orderBy(F.col("order_count").desc(), "order_status"))


def item_status_distribution(fact_items: DataFrame) -> DataFrame:
    """Items, quantity and exact line value per item status."""
    from ledgerline.functions.columns import line_value
    return (fact_items.groupBy("item_status")
            .agg(F.count(F.lit(1)).alias("item_count"),
                 F.sum("quantity").cast(T.LongType()).alias("total_quantity"),
                 F.sum(line_value()).cast(T.DoubleType()).alias("total_amount"))
            .orderBy(F.col("item_count").desc(), "item_status"))
