"""Quality rules over a stream: passing rows and per-rule counts of every micro-batch.

``CheckedStream`` is a ``foreachBatch`` target with two folders under ``root``:
``rows/batch_id=N`` holds the rows of micro-batch N that meet every rule,
``metrics/batch_id=N`` one row per rule with its pass and fail counts.  The counts
are observed while the rows are written, so a batch is read once.  Both
folders are overwritten by a replay; the metrics are written last and a batch
counts only with them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.quality import expect_or_drop_observed

METRICS = "dataset string, rule string, passed_records long, failed_records long"


class CheckedStream:
    def __init__(self, spark: SparkSession, root: str, rules: Mapping[str, str], dataset: str, schema):
        self.spark, self.root, self.rules, self.dataset = spark, root.rstrip("/"), dict(rules), dataset
        self.schema = schema

    def apply_batch(self, batch: DataFrame, batch_id: int) -> None:
        kept, seen = expect_or_drop_observed(batch, self.rules, f"{self.dataset}-{batch_id}")
        kept.write.mode("overwrite").parquet(f"{self.root}/rows/batch_id={batch_id}")
        counts = seen.get
        rows = [(self.dataset, rule, counts[rule], counts["total"] - counts[rule]) for rule in self.rules]
        (self.spark.createDataFrame(rows, METRICS).coalesce(1)
            .write.mode("overwrite").parquet(f"{self.root}/metrics/batch_id={batch_id}"))

    def batch_metrics(self) -> DataFrame:
        """One row per micro-batch and rule."""
        return self.spark.read.schema(f"{METRICS}, batch_id long").option("basePath", f"{self.root}/metrics") \
            .parquet(f"{self.root}/metrics")

    def metrics(self) -> DataFrame:
        """Counts per rule over all micro-batches."""
        return self.batch_metrics().groupBy("dataset", "rule").agg(
            F.sum("passed_records").alias("passed_records"), F.sum("failed_records").alias("failed_records"))

    def rows(self) -> DataFrame:
        """The rows of all finished micro-batches that met every rule."""
        known = self.batch_metrics().select("batch_id").distinct()
        rows = self.spark.read.schema(f"{_ddl(self.schema)}, batch_id long").option(
            "basePath", f"{self.root}/rows").parquet(f"{self.root}/rows")
        return rows.join(known, "batch_id", "left_semi").drop("batch_id")

    def run(self, source_dir: str, files_per_batch: int = 1) -> None:
        """Take in all files of ``source_dir``, ``files_per_batch`` at a time."""
        stream = (self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", files_per_batch)
                  .parquet(source_dir))
        query = (stream.writeStream.foreachBatch(self.apply_batch).trigger(availableNow=True)
                 .option("checkpointLocation", f"{self.root}/_checkpoint").start())
        query.awaitTermination()


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
