"""Layers handed on through catalog tables, schema-replacing overwrites, stored histories, partition refresh.

``Layers`` writes bronze once from the source and builds each later layer from
the tables of the one before: silver from bronze, gold and history from silver.

``replace_table`` swaps a table for one of another schema: the new rows are
written as a table of their own, then a view of the public name is pointed at
it, so that a reader sees the old or the new table, whole.

``write_history`` stores versions by validity: the open ones in a partition of
their own, closed ones by month of their end, bucketed by key.  Current and
point-in-time reads prune partitions; a join of current versions on the bucket key
has no exchange.

``refresh_orders`` takes in a new arrival folder: it knows which calendar
partitions of the order facts each arrival folder feeds, rebuilds only those that the
new folder touches, from the folders that feed them, and overwrites them in place.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.constants import CURRENT, END_AT, START_AT
from ledgerline.operators import gold, silver
from ledgerline.operators.scd2 import apply_scd2, null_safe_join
from ledgerline.plans.lakehouse import ITEM_TRACKED, ORDER_TRACKED, Lakehouse
from ledgerline.session import hand_off, scratch_path
from ledgerline.sources.files import bucket_number, read_table, write_bucketed_table, write_table

BRONZE = ("status", "products", "customers", "orders", "order_items", "order_change_feed", "item_change_feed")
#: Row order within the files of the large bronze tables: near ids pack well there, in silver and in shuffles.
BRONZE_ORDER = {"orders": ("order_id",), "order_items": ("order_id", "order_item_id"),
                "order_change_feed": ("order_id",), "item_change_feed": ("order_id", "order_item_id")}
SPLIT, SORTED_SPLIT = "spark.sql.files.maxPartitionBytes", "32m"
SILVER = ("silver_status", "silver_products", "silver_customers", "silver_orders", "silver_order_items")


def create_database(spark: SparkSession, name: str | None = None, location: str | None = None) -> str:
    """``CREATE SCHEMA`` with its tables under the shared folder (or ``location``)."""
    name = name or f"ledgerline_{uuid.uuid4().hex[:12]}"
    location = location or scratch_path(spark, f"db-{name}")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} LOCATION '{location}'")
    return name


class TableSource:
    """The raw tables of the order model, read from bronze catalog tables."""

    def __init__(self, spark: SparkSession, database: str):
        self.spark, self.database = spark, database

    def __getattr__(self, name: str):
        if name not in BRONZE:
            raise AttributeError(name)
        return lambda: read_table(self.spark, f"{self.database}.bronze_{name}")


class Layers(Lakehouse):
    """The lakehouse over catalog tables of ``database``, each layer read from the one before."""

    def __init__(self, spark: SparkSession, database: str, **kw):
        super().__init__(TableSource(spark, database), **kw)
        self.database = database

    def _stored(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.database}.{name}")

    # gold and history read the written silver tables
    silver_status = property(lambda self: self._stored("silver_status"))
    silver_products = property(lambda self: self._stored("silver_products"))
    silver_customers = property(lambda self: self._stored("silver_customers"))
    silver_orders = property(lambda self: self._stored("silver_orders"))
    silver_order_items = property(lambda self: self._stored("silver_order_items"))
    order_feed = property(lambda self: silver.active_orders(self._stored("silver_order_changes")))
    item_feed = property(lambda self: self._stored("silver_item_changes"))

    @classmethod
    def build(cls, source, database: str | None = None, buckets: int = 8, histories: bool = True, **kw) -> "Layers":
        """Write bronze, silver, gold and history as tables; every raw table is scanned once."""
        spark = source.spark
        database = create_database(spark, database)
        put = lambda df, name: write_table(df, f"{database}.{name}")
        split = spark.conf.get(SPLIT)
        spark.conf.set(SPLIT, SORTED_SPLIT)                   # a task sorts what it reads without spilling
        try:
            for name in BRONZE if histories else BRONZE[:5]:
                raw = getattr(source, name)()
                put(raw.sortWithinPartitions(*BRONZE_ORDER[name]) if name in BRONZE_ORDER else raw, f"bronze_{name}")
        finally:
            spark.conf.set(SPLIT, split)
        plain = Lakehouse(TableSource(spark, database), **kw)
        for name in SILVER:
            put(getattr(plain, name), name)
        layers = cls(spark, database, **kw)
        put(layers.dim_customers, "dim_customers")
        put(layers.dim_products, "dim_products")
        put(layers.pipeline_dim_products, "pipeline_dim_products")
        for name in ("fact_orders", "fact_order_items"):
            write_bucketed_table(getattr(layers, name), f"{database}.{name}", buckets, ["order_id"], sort_by=["order_id"])
        if histories:
            put(silver.silver_orders(layers.model.order_change_feed(), layers.source_zone), "silver_order_changes")
            put(silver.silver_order_items(layers.model.item_change_feed(), layers.source_zone), "silver_item_changes")
            for name, feed, key, tracked in (
                    ("history_orders", layers.stage_fact_orders, "order_id", ORDER_TRACKED),
                    ("history_order_items", layers.stage_fact_order_items, "order_item_id", ITEM_TRACKED)):
                versions = placed_history(feed, [key], "updated_at", tracked, ["order_id"], buckets, **layers.scd_options)
                write_history(versions, f"{database}.{name}", ["order_id"], buckets, placed=True)
        return layers

    def table(self, name: str) -> DataFrame:
        """A written table of the database."""
        return self._stored(name)


# ------------------------------------------------------------ schema replacement

def schema_difference(old: DataFrame | None, new: DataFrame) -> dict[str, list[str]]:
    """Columns added, dropped and retyped by replacing ``old`` with ``new``."""
    before, after = dict(old.dtypes) if old is not None else {}, dict(new.dtypes)
    return {"added": [c for c in after if c not in before], "dropped": [c for c in before if c not in after],
            "retyped": [c for c in after if c in before and after[c] != before[c]]}


def replace_table(df: DataFrame, name: str, keep: int = 1) -> dict[str, list[str]]:
    """Point ``name`` at a new table of ``df``'s rows and schema; returns the schema difference.

    ``df`` may read ``name``.  The ``keep`` tables before the new one stay for
    readers that have begun; older ones are dropped.
    """
    spark = df.sparkSession
    old = spark.table(name) if spark.catalog.tableExists(name) else None
    difference = schema_difference(old, df)
    database, _, short = name.rpartition(".")
    prefix = f"{short}__v"
    where = f" IN {database}" if database else ""
    versions = sorted(int(r["tableName"][len(prefix):]) for r in spark.sql(f"SHOW TABLES{where}").collect()
                      if r["tableName"].startswith(prefix))
    dot = f"{database}." if database else ""
    version = versions[-1] + 1 if versions else 1
    write_table(df, f"{dot}{prefix}{version}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {dot}{prefix}{version}")
    for v in versions[:len(versions) - keep] if keep else versions:
        spark.sql(f"DROP TABLE {dot}{prefix}{v}")
    return difference


# ------------------------------------------------------------ stored histories

#: Partition column: month (yyyymm) in which a version ended; ``OPEN`` while it is current.
END_MONTH = "end_month"
OPEN = 999912
_BUCKET, _PLACE = "_bucket", "_place"


def _month(c):
    return F.year(c) * 100 + F.month(c)


def write_history(history: DataFrame, table: str, by: Sequence[str], buckets: int = 64, placed: bool = False) -> None:
    """Store versions by validity, bucketed and sorted on ``by``; ``placed`` rows are not shuffled for it."""
    rows = history.withColumn(END_MONTH, F.coalesce(_month(F.col(END_AT)), F.lit(OPEN)))
    write_bucketed_table(rows, table, buckets, by, partition_by=[END_MONTH], sort_by=list(by), placed=placed)


def placed_history(changes: DataFrame, keys: Sequence[str], sequence_by: str, track_history: Sequence[str],
                   by: Sequence[str], buckets: int, **options) -> DataFrame:
    """``apply_scd2`` whose rows lie by bucket of ``by``: one shuffle serves the windows and a bucketed write.

    The changes are ranged by (bucket, hash of ``by``).  A key with one such hash lies in
    one range, so windows over (bucket, hash, key) are windows over the key.  Keys with
    several (an item moved to another order) take the shuffle by key, and their versions one by ``by``.
    """
    place = {_BUCKET: bucket_number(buckets, by), _PLACE: F.hash(*by)}
    rest, moved = changes, None
    if not set(by) <= set(keys):
        # few rows of a key meet in one task: bare pairs are a smaller shuffle than partial sums
        pairs = changes.where(F.col(sequence_by).isNotNull()).select(*keys, place[_PLACE].alias(_PLACE)).repartition(*keys)
        found = pairs.groupBy(*keys).agg(F.min(_PLACE).alias("_low"), F.max(_PLACE).alias("_high"))
        moved = hand_off(found.where("_low <> _high").select(*keys), "moved-keys")
        if moved.isEmpty():
            moved = None
        else:
            rest = null_safe_join(changes, moved, keys, "left_anti")
    ranged = rest.repartitionByRange(*place.values()).withColumns(place)
    placed = apply_scd2(ranged, [*place, *keys], sequence_by, track_history,
                        sample_source=rest.withColumns(place), **options).drop(*place)
    if moved is None:
        return placed
    again = apply_scd2(null_safe_join(changes, moved, keys, "left_semi"), keys, sequence_by, track_history, **options)
    return placed.unionByName(again.hint("rebalance", buckets, *by))


def stored_current(history: DataFrame) -> DataFrame:
    """Current versions: one partition."""
    return history.where((F.col(END_MONTH) == OPEN) & F.col(CURRENT)).drop(END_MONTH)


def stored_as_of(history: DataFrame, when: dt.datetime, columns: Sequence[str]) -> DataFrame:
    """State at ``when``: partitions that ended before its month are not read."""
    from ledgerline.operators.history import as_of
    return as_of(history.where(F.col(END_MONTH) >= when.year * 100 + when.month), when, columns)


def stored_current_join(orders: DataFrame, items: DataFrame, on: str) -> DataFrame:
    """Current versions of two stored histories bucketed on ``on``, joined where they lie."""
    left, right = (stored_current(h).drop(START_AT, END_AT, CURRENT) for h in (orders, items))
    return left.alias("l").join(right.alias("r"), on)


# ------------------------------------------------------------ partition refresh

ARRIVAL = ("year", "month")


def order_facts(raw_orders: DataFrame, source_zone: str = "UTC") -> DataFrame:
    """Order facts of raw orders."""
    return gold.fact_orders(silver.active_orders(silver.silver_orders(raw_orders, source_zone)))


def dependencies(raw_orders: DataFrame, source_zone: str = "UTC") -> DataFrame:
    """(year, month, order_year, order_month, order_day): which calendar partition each arrival folder feeds."""
    return silver.silver_orders(raw_orders, source_zone).select(*ARRIVAL, *silver.ORDER_PARTITIONS).distinct()


def refresh_orders(raw_orders: DataFrame, year: int, month: int, root: str, source_zone: str = "UTC") -> DataFrame:
    """Take the arrival folder (year, month) of ``raw_orders`` into the facts under ``root``; returns the partitions rewritten.

    ``raw_orders`` is the scan of all arrival folders.  ``root/depends`` records, per
    arrival folder, the calendar partitions it feeds, so that only folders that share
    one with the new folder are read again.  Repeating a refresh gives the same facts.
    """
    spark = raw_orders.sparkSession
    days = list(silver.ORDER_PARTITIONS)
    here = (F.col("year") == year) & (F.col("month") == month)
    depends = f"{root}/depends"
    dynamic = {"partitionOverwriteMode": "dynamic"}
    write_table(dependencies(raw_orders.where(here), source_zone), depends, partition_by=ARRIVAL, options=dynamic)
    known = spark.read.parquet(depends)
    touched = known.where(here).select(*days).distinct()
    folders = known.join(touched, days, "left_semi").select(*ARRIVAL).distinct().collect()  # arrival months: few
    need = F.lit(False)
    for f in folders:
        need = need | ((F.col("year") == f["year"]) & (F.col("month") == f["month"]))
    facts = order_facts(raw_orders.where(need), source_zone)
    same = [facts[c].eqNullSafe(touched[c]) for c in days]
    part = facts.join(touched, same[0] & same[1] & same[2], "left_semi")
    write_table(part, f"{root}/facts", partition_by=days, options=dynamic)
    return touched
