"""Sources and sinks: CSV / parquet / table readers and writers, and the
mapping of the driver's TPC-H-style tables onto the order model."""

from ledgerline.sources.files import (
    create_schema, read_csv, read_table, write_table,
)
from ledgerline.sources.model import OrderModel

__all__ = ["create_schema", "read_csv", "read_table", "write_table", "OrderModel"]
