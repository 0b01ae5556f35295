"""The source system's raw CSV layout.

::

    <root>/master_data/status/*.csv
    <root>/master_data/products/*.csv
    <root>/master_data/customers/*.csv
    <root>/transactions_data/orders/year=YYYY/month=MM/*.csv
    <root>/transactions_data/order_items/year=YYYY/month=MM/*.csv

Timestamps carry a region zone after the time (``2026-05-15 11:00:00
America/New_York``), possibly different per row; they are read as instants
(``TimestampType``).  The arrival folders become int ``year``/``month``
columns.  Reads are typed by default (one pass); ``infer=True`` keeps the
exploratory ``inferSchema`` read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerline import schemas
from ledgerline.sources.files import read_csv

ZONED_TIMESTAMP = "yyyy-MM-dd HH:mm:ss VV"


def _instants(schema: T.StructType) -> T.StructType:
    """The schema with wall-clock timestamps replaced by instants."""
    return T.StructType([
        T.StructField(f.name, T.TimestampType() if isinstance(f.dataType, T.TimestampNTZType)
                      else f.dataType, f.nullable) for f in schema.fields])


class RawCsvSource:
    """Raw tables of one CSV drop, with the methods ``Lakehouse`` expects."""

    def __init__(self, spark: SparkSession, root: str, infer: bool = False,
                 timestamp_format: str = ZONED_TIMESTAMP, on_bad: str = "fail"):
        """``on_bad``: ``fail`` stops a typed read at a field that does not
        parse; ``null`` keeps the row with NULL there (count them with
        ``count_null_sequences`` before building a history)."""
        if on_bad not in ("fail", "null"):
            raise ValueError("on_bad must be 'fail' or 'null'")
        self.on_bad = on_bad
        self.spark = spark
        self.root = root.rstrip("/")
        self.infer = infer
        self.timestamp_format = timestamp_format

    def _read(self, sub: str, schema: T.StructType, partitioned: bool = False) -> DataFrame:
        path = f"{self.root}/{sub}"
        parts = schemas.ARRIVAL_PARTITIONS if partitioned else ()
        reader_schema = None if self.infer else _instants(schema)
        df = read_csv(self.spark, path, schema=reader_schema, infer=self.infer,
                      partition_columns=parts, timestamp_format=self.timestamp_format,
                      mode="FAILFAST" if self.on_bad == "fail" and not self.infer else None)
        return df

    def status(self) -> DataFrame:
        return self._read("master_data/status", schemas.STATUS)

    def products(self) -> DataFrame:
        return self._read("master_data/products", schemas.PRODUCTS)

    def customers(self) -> DataFrame:
        return self._read("master_data/customers", schemas.CUSTOMERS)

    def orders(self) -> DataFrame:
        return self._read("transactions_data/orders", schemas.ORDERS, partitioned=True)

    def order_items(self) -> DataFrame:
        return self._read("transactions_data/order_items", schemas.ORDER_ITEMS, partitioned=True)

    def order_change_feed(self) -> DataFrame:
        """Every order row delivered so far is one change of that order."""
        return self.orders().drop(*schemas.ARRIVAL_PARTITIONS)

    def item_change_feed(self) -> DataFrame:
        return self.order_items().drop(*schemas.ARRIVAL_PARTITIONS)
