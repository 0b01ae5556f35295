"""Sharding by sampled splitters: shards of nearly equal bytes, equal texts side by side.

Records are ordered by a hash of their text, then by doc_id.

1. Draw a sample of keys, each record with probability in proportion to its
   size, so that about ``SAMPLE`` are drawn whatever the table's size, and take
   evenly spaced sample keys as splitters.
2. Range-partition the records.  Ranges that hold more than twice their share
   (one text with very many copies) are subdivided by a hash of doc_id, so
   that no task gets more than a few shares.
3. Sum bytes per sub-range, then lay the records along a line in key order.
   Records larger than 1/64 of a shard (at most 64 a shard) are dealt first,
   largest to the emptiest shard; the rest fill what is left, cut at byte
   quantiles.  A group of equal texts is only split where a cut meets it.

Law: ``bytes``.  Slots number a shard's records in key order from 0.

Edge cases: a null text has no bytes (size 1, checksum 0) and is ordered like
an empty one; rows that repeat a doc_id are separate records; a null doc_id is
kept; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import batches, drop_written, need, prepare, written

SHARDS = 8
#: Expected number of sampled keys.
SAMPLE = 8192
#: A record above 1/LARGE of a shard is dealt on its own.
LARGE = 64


def records(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, key (hash of the text) and draw (uniform in [0, 1), from key and doc_id)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = need(docs, "doc_id", "text").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("key"))
    tie = F.xxhash64("key", F.coalesce("doc_id", F.lit(-1)), F.lit("draw"))
    return rows.withColumn("draw", F.shiftrightunsigned(tie, 11) / float(1 << 53))


def splitters(rows: DataFrame, total: int, ranges: int, sample: int = SAMPLE) -> np.ndarray:
    """At most ``ranges - 1`` rising keys that cut the sampled bytes evenly."""
    drawn = rows.where(F.col("draw") < F.col("size") * F.lit(sample / max(total, 1))).select("key").collect()
    keys = np.sort(np.array([r["key"] for r in drawn], np.int64))
    if not len(keys):
        return keys
    at = (np.arange(1, ranges) * len(keys)) // ranges
    return np.unique(keys[at])


def into_ranges(rows: DataFrame, cuts: np.ndarray) -> DataFrame:
    """``rows`` with the range of each key: how many splitters are not above it."""

    def run(source):
        for b in batches(source):
            at = np.searchsorted(cuts, b.column("key").to_numpy(zero_copy_only=False), "right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at)], names=[*b.schema.names, "range"])

    return rows.mapInArrow(run, "doc_id long, size long, text_crc32 long, key long, range int")


def deal_large(sizes: list[int], total: int, shards: int) -> tuple[list[int], np.ndarray]:
    """(shard of each large record, largest first; bytes left for the others in each shard)."""
    held = np.zeros(shards, np.int64)
    where = []
    for size in sizes:
        s = int(np.argmin(held))
        held[s] += size
        where.append(s)
    # raise the emptiest shards to one common level with the remaining bytes
    rest = total - int(held.sum())
    order = np.sort(held)
    for k in range(1, shards + 1):
        level = (rest + int(order[:k].sum())) / k
        if k == shards or level <= order[k]:
            break
    return where, np.maximum(0, level - held)


def assign(docs: DataFrame, shards: int = SHARDS, sample: int = SAMPLE) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every record."""
    spark = docs.sparkSession
    prepare(spark)
    base, base_path = written(records(docs), "op10-records")
    total = base.agg(F.sum("size")).first()[0] or 0
    ranges = max(4 * shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = splitters(base, total, ranges, sample)
    ranged = into_ranges(base.drop("draw"), cuts)

    share = max(1.0, total / ranges)
    held = ranged.groupBy("range").agg(F.sum("size").alias("bytes")).collect()  # one row per range
    parts = {r["range"]: int(-(-r["bytes"] // share)) for r in held if r["bytes"] > 2 * share}
    sub = F.lit(0)
    if parts:
        n = F.create_map(*[F.lit(x) for kv in parts.items() for x in kv])[F.col("range")]
        sub = F.coalesce(F.pmod(F.xxhash64("doc_id"), n), F.lit(0)).cast("int")
    cells = sum(parts.values()) + ranges
    bound = total / shards / LARGE
    placed = ranged.withColumn("sub", sub).withColumn("large", F.col("size") > bound)
    placed, placed_path = written(placed.repartition(max(cells, 1), "range", "sub"), "op10-ranges")

    large = placed.where("large").select("doc_id", "size", "key", "range", "sub").orderBy(
        F.desc("size"), "key", "doc_id").collect()  # fewer than shards * LARGE
    where, room = deal_large([r["size"] for r in large], total, shards)
    ends = np.cumsum(room)

    # bytes of earlier sub-ranges: one row per sub-range
    cell = placed.groupBy("range", "sub").agg(F.sum(F.when(~F.col("large"), F.col("size")).otherwise(0)).alias("bytes"))
    cell = cell.select("range", "sub", (F.sum("bytes").over(W.orderBy("range", "sub")) - F.col("bytes")).alias("before"))
    in_cell = W.partitionBy("range", "sub").orderBy("key", "doc_id", "text_crc32", "size")
    small = F.when(F.col("large"), F.lit(0)).otherwise(F.col("size"))
    line = placed.join(cell, ["range", "sub"]).withColumn(
        "at", F.col("before") + F.sum(small).over(in_cell.rowsBetween(W.unboundedPreceding, 0)) - F.col("size") / 2)
    by_bytes = F.lit(shards - 1)
    for s in reversed(range(shards - 1)):
        by_bytes = F.when(F.col("at") < float(ends[s]), s).otherwise(by_bytes)
    shard = by_bytes
    if large:
        # equal large records (same key, doc_id and size) are dealt in the order of their rank
        ranks: dict[tuple, int] = {}
        known = []
        for r, s in zip(large, where):
            k = (r["key"], r["doc_id"], r["size"])
            ranks[k] = ranks.get(k, 0) + 1
            known.append((r["range"], r["sub"], *k, ranks[k], s))
        table = spark.createDataFrame(known, "range int, sub int, key long, doc_id long, size long, copy int, dealt int")
        twin = W.partitionBy("range", "sub", "key", "doc_id", "size").orderBy("text_crc32")
        line = line.withColumn("copy", F.when(F.col("large"), F.row_number().over(twin)))
        same = [line[c].eqNullSafe(table[c]) for c in ("range", "sub", "key", "doc_id", "size", "copy")]
        cond = same[0]
        for c in same[1:]:
            cond = cond & c
        line = line.join(F.broadcast(table.withColumnRenamed("dealt", "dealt_to")), cond, "left").select(
            *[line[c] for c in line.columns], "dealt_to")
        shard = F.coalesce(F.col("dealt_to"), by_bytes)
    line = line.withColumn("shard", shard.cast("int")).select(
        "doc_id", "size", "text_crc32", "key", "range", "sub", "shard")
    line, line_path = written(line, "op10-line")
    drop_written(spark, base_path, placed_path)

    counts = line.groupBy("shard", "range", "sub").agg(F.count("*").alias("n"))
    counts = counts.select("shard", "range", "sub", (F.sum("n").over(
        W.partitionBy("shard").orderBy("range", "sub")) - F.col("n")).alias("earlier"))
    here = W.partitionBy("shard", "range", "sub").orderBy("key", "doc_id", "text_crc32", "size")
    return line.join(counts, ["shard", "range", "sub"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("earlier") + F.row_number().over(here) - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write the documents, with their slot, in one folder per shard (doc_id must be unique)."""
    placed = assign(docs, shards).select("doc_id", "shard", "slot")
    docs.join(placed, "doc_id").repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard").parquet(path)
