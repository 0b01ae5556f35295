"""The layered lakehouse as lazily composed DataFrames.

``Lakehouse`` wires raw -> bronze -> silver -> gold -> history for one source
of raw tables.  Nothing runs until an action; Catalyst sees each report as one
plan from the source scans to the result, so filters and column pruning reach
the parquet readers.  ``materialize`` writes the layers as tables (the
source system's table hand-off), partitioning the order facts by
order_year/order_month/order_day so calendar filters prune.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from ledgerline.operators import gold, silver
from ledgerline.operators.history import latest_state
from ledgerline.operators.scd2 import apply_scd2
from ledgerline.sources.model import OrderModel

ORDER_TRACKED = ("order_status", "total_amount")
ITEM_TRACKED = ("item_status", "quantity", "unit_price")


class Lakehouse:
    def __init__(self, model: OrderModel, source_zone: str = "UTC",
                 scd_options: dict | None = None):
        self.model = model
        self.spark = model.spark
        self.source_zone = source_zone
        self.scd_options = dict(scd_options or {})

    # -- bronze: the raw tables as loaded ----------------------------------
    @cached_property
    def bronze_status(self) -> DataFrame:
        return self.model.status()

    @cached_property
    def bronze_products(self) -> DataFrame:
        return self.model.products()

    @cached_property
    def bronze_customers(self) -> DataFrame:
        return self.model.customers()

    @cached_property
    def bronze_orders(self) -> DataFrame:
        return self.model.orders()

    @cached_property
    def bronze_order_items(self) -> DataFrame:
        return self.model.order_items()

    # -- silver -------------------------------------------------------------
    @property
    def silver_status(self) -> DataFrame:
        return silver.silver_status(self.bronze_status)

    @property
    def silver_products(self) -> DataFrame:
        return silver.silver_products(self.bronze_products)

    @property
    def silver_customers(self) -> DataFrame:
        return silver.silver_customers(self.bronze_customers)

    @property
    def silver_orders(self) -> DataFrame:
        return silver.silver_orders(self.bronze_orders, self.source_zone)

    @property
    def silver_orders_active(self) -> DataFrame:
        return silver.active_orders(self.silver_orders)

    @property
    def silver_orders_inactive(self) -> DataFrame:
        return silver.inactive_orders(self.silver_orders)

    @property
    def silver_order_items(self) -> DataFrame:
        return silver.silver_order_items(self.bronze_order_items, self.source_zone)

    # -- gold (plain, full refresh) ------------------------------------------
    @property
    def dim_customers(self) -> DataFrame:
        return gold.dim_customers(self.silver_customers)

    @property
    def dim_products(self) -> DataFrame:
        return gold.dim_products(self.silver_products)

    @property
    def fact_orders(self) -> DataFrame:
        return gold.fact_orders(self.silver_orders_active)

    @property
    def fact_order_items(self) -> DataFrame:
        return gold.fact_order_items(self.silver_order_items)

    # -- gold (pipeline: rule-checked dims, staging, version history) ---------
    @property
    def pipeline_dim_customers(self) -> DataFrame:
        return gold.pipeline_dim_customers(self.silver_customers)

    @property
    def pipeline_dim_products(self) -> DataFrame:
        return gold.pipeline_dim_products(self.silver_products)

    @property
    def order_feed(self) -> DataFrame:
        """Silver-shaped order change feed (active statuses only)."""
        feed = silver.silver_orders(self.model.order_change_feed(), self.source_zone)
        return silver.active_orders(feed)

    @property
    def item_feed(self) -> DataFrame:
        return silver.silver_order_items(self.model.item_change_feed(), self.source_zone)

    @property
    def stage_fact_orders(self) -> DataFrame:
        return gold.stage_fact_orders(self.order_feed)

    @property
    def stage_fact_order_items(self) -> DataFrame:
        return gold.stage_fact_order_items(self.item_feed)

    @cached_property
    def history_orders(self) -> DataFrame:
        opts = dict(self.scd_options)
        keys_scan = getattr(self.model, "order_feed_keys", None)
        if keys_scan is not None and "hot_keys" not in opts:
            opts.setdefault("sample_source", keys_scan())
        return apply_scd2(self.stage_fact_orders, keys=["order_id"],
                          sequence_by="updated_at",
                          track_history=list(ORDER_TRACKED), **opts)

    @cached_property
    def history_order_items(self) -> DataFrame:
        return apply_scd2(self.stage_fact_order_items, keys=["order_item_id"],
                          sequence_by="updated_at",
                          track_history=list(ITEM_TRACKED), **self.scd_options)

    @cached_property
    def history_events(self) -> DataFrame:
        return apply_scd2(self.model.events(), keys=["user_id"], sequence_by="ts",
                          track_history=["event_type"], **self.scd_options)

    # -- latest state: the current versions' values without their history ----
    @property
    def current_orders(self) -> DataFrame:
        return latest_state(self.stage_fact_orders, ["order_id"], "updated_at")

    @property
    def current_order_items(self) -> DataFrame:
        return latest_state(self.stage_fact_order_items, ["order_item_id"], "updated_at")

    # -- materialization ---------------------------------------------------
    def materialize_catalog(self, database: str, buckets: int = 64,
                            fmt: str = "parquet", partition_facts: bool = False) -> dict[str, str]:
        """Write the gold layer as catalog tables of ``database``.

        Order and item facts are bucketed on ``order_id`` with the same
        bucket count, so the reports' fact-to-fact join reads both sides
        already clustered and needs no shuffle.  ``partition_facts`` adds the
        calendar partitioning of the order facts (more files: partitions x
        buckets).  Returns name -> table.
        """
        from ledgerline.sources.files import create_schema, write_bucketed_table, write_table
        create_schema(self.spark, database)
        out = {}
        for name, df in (("dim_customers", self.dim_customers),
                         ("dim_products", self.dim_products),
                         ("pipeline_dim_products", self.pipeline_dim_products)):
            write_table(df, f"{database}.{name}", fmt=fmt)
            out[name] = f"{database}.{name}"
        part = silver.ORDER_PARTITIONS if partition_facts else ()
        write_bucketed_table(self.fact_orders, f"{database}.fact_orders", buckets,
                             ["order_id"], fmt=fmt, partition_by=part, sort_by=["order_id"])
        write_bucketed_table(self.fact_order_items, f"{database}.fact_order_items", buckets,
                             ["order_id"], fmt=fmt, sort_by=["order_id"])
        out["fact_orders"] = f"{database}.fact_orders"
        out["fact_order_items"] = f"{database}.fact_order_items"
        return out

    def materialize(self, root: str, fmt: str = "parquet",
                    only: tuple[str, ...] | None = None) -> dict[str, str]:
        """Write silver and gold layers under ``root``; return name -> path.

        ``only`` restricts the write to the named tables (e.g. the gold ones).

        Downstream reads of these paths start new, short lineages (the table
        hand-off between layers).  Row counts of the written tables are
        observed during the writes and left in ``written_rows``.
        """
        from ledgerline.sources.files import write_table
        part = list(silver.ORDER_PARTITIONS)
        plan = {
            "silver/status": (self.silver_status, ()),
            "silver/products": (self.silver_products, ()),
            "silver/customers": (self.silver_customers, ()),
            "silver/orders__active": (self.silver_orders_active, part),
            "silver/orders__inactive": (self.silver_orders_inactive, part),
            "silver/order_items": (self.silver_order_items, ()),
            "gold/dim_customers": (self.dim_customers, ()),
            "gold/dim_products": (self.dim_products, ()),
            "gold/fact_orders": (self.fact_orders, part),
            "gold/fact_order_items": (self.fact_order_items, ()),
            "pipeline/dim_customers": (self.pipeline_dim_customers, ()),
            "pipeline/dim_products": (self.pipeline_dim_products, ()),
            # an order's calendar columns are the same in all its versions, so
            # the history partitions cleanly by month and reports prune it
            "pipeline/fact_orders": (lambda: self.history_orders, ("order_year", "order_month")),
            "pipeline/fact_order_items": (lambda: self.history_order_items, ()),
        }
        from pyspark.sql import Observation
        from pyspark.sql import functions as F
        paths = {}
        self.written_rows: dict[str, int] = {}
        for name, (df, by) in plan.items():
            if only is not None and name not in only:
                continue
            if callable(df):
                df = df()
            path = f"{root.rstrip('/')}/{name}"
            # the row count comes with the write (no second pass over the data)
            obs = Observation(name.replace("/", "_"))
            write_table(df.observe(obs, F.count(F.lit(1)).alias("rows")), path,
                        fmt=fmt, partition_by=by)
            paths[name] = path
            self.written_rows[name] = obs.get["rows"]
        return paths
