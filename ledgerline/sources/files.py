"""File and table I/O (raw CSV scans, table scans, overwrite sinks)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: How Parquet tables are written, once per layer, to be read often: version 2 packs ids by their differences.
PARQUET_OPTIONS = {"compression": "zstd", "parquet.compression.codec.zstd.level": "6", "parquet.writer.version": "v2"}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             infer: bool = False, header: bool = True,
             partition_columns: Sequence[str] = (),
             timestamp_format: str | None = None, mode: str | None = None) -> DataFrame:
    """Read one CSV file, a folder of them, or Hive-style ``k=v`` folders.

    With ``schema`` the read is a single pass and typed; ``infer=True`` keeps
    the exploratory behaviour (``inferSchema``, one extra pass).  Partition
    folder values become columns (``month=05`` -> 5); with a schema their
    types are taken as int.
    """
    reader = spark.read.option("header", header)
    if mode:
        reader = reader.option("mode", mode)
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format)
    if schema is not None:
        full = T.StructType(list(schema.fields) + [
            T.StructField(c, T.IntegerType()) for c in partition_columns
            if c not in schema.fieldNames()])
        # A user schema that names the partition columns types them too.
        reader = reader.schema(full)
    else:
        reader = reader.option("inferSchema", infer)
    return reader.csv(path)


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """Scan a catalog table by name, or a storage path."""
    if "/" in name_or_path or ":" in name_or_path:
        return spark.read.format(fmt).load(name_or_path)
    return spark.table(name_or_path)


def create_schema(spark: SparkSession, name: str) -> None:
    """``CREATE SCHEMA IF NOT EXISTS`` in the session catalog."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def write_table(df: DataFrame, target: str, fmt: str = "parquet",
                partition_by: Sequence[str] = (), mode: str = "overwrite",
                overwrite_schema: bool = True, options: dict | None = None) -> None:
    """Overwrite a table (by name) or a path, optionally partitioned.

    Partitioned writes first ``rebalance`` on the partition columns: rows of
    one partition value land in few files, and AQE splits a value that holds
    a large share of the rows over several tasks instead of one.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    if fmt == "parquet":
        writer = writer.options(**PARQUET_OPTIONS)
    for key, value in (options or {}).items():
        writer = writer.option(key, value)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if overwrite_schema and fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    if "/" in target or ":" in target:
        writer.save(target)
    else:
        writer.saveAsTable(target)


def bucket_number(buckets: int, by: Sequence[str]) -> Column:
    """The bucket of a row in a table bucketed on ``by``."""
    return F.pmod(F.hash(*by), F.lit(buckets))


def write_bucketed_table(df: DataFrame, table: str, buckets: int, by: Sequence[str],
                         fmt: str = "parquet", partition_by: Sequence[str] = (),
                         sort_by: Sequence[str] = (), placed: bool = False) -> None:
    """Overwrite a catalog table bucketed (hash-clustered) on ``by``.

    Two tables bucketed on the join key with the same bucket count join
    without a shuffle (sort-merge join straight off the scans).  Rows are
    first rebalanced on the bucket key into ``buckets`` partitions (the same
    hash as the buckets, so a task writes one file per bucket); AQE splits a
    bucket holding a large share of the rows over several tasks, and that
    bucket then has several files, which bucketed reads allow.  ``placed`` rows
    already lie by bucket (``bucket_number``) and are not shuffled again.
    """
    rows = df if placed else df.hint("rebalance", buckets, *by)
    writer = rows.write.format(fmt).mode("overwrite").bucketBy(buckets, *by)
    if fmt == "parquet":
        writer = writer.options(**PARQUET_OPTIONS)
    if sort_by:
        writer = writer.sortBy(*sort_by)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)
