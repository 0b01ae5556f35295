"""Token-ID output: documents in doc_id order as blocks of Simple-8b words.

File format: a Parquet folder whose files hold one row per block, in order:

* ``part`` and ``block``: place of the block; blocks of a part follow each other;
* ``first``: ids of the part before the block;
* ``doc_ids`` and ``lengths``: the block's documents in order, whole documents only;
* ``words``: little-endian 64-bit Simple-8b words;
* ``frame_words``: words of each frame of 256 ids (the offsets for decoding any frame alone);
* ``escapes``: little-endian 64-bit values too wide for a word.

Parts are ranges of doc_id, written by one task each through Spark's committed
writer, so a lost executor only repeats its own parts.

Edge cases: a null or empty text is the end id alone.  Rows that repeat a
doc_id are separate documents, in order of a hash of their text.  A null doc_id sorts
first.  An empty table gives no block and no row.  Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import simple8b
from .common import batches, need, prepare, written
from .tokens import encoder

END_ID = 2
#: Ids at which a block is closed; a longer document is one block.
BLOCK_IDS = 1 << 16

SCHEMA = ("part int, block long, first long, doc_ids array<long>, lengths array<long>, "
          "words binary, frame_words binary, escapes binary")


def encode_blocks(docs: DataFrame, tokenizer: str, end_id: int = END_ID, parts: int | None = None) -> DataFrame:
    """Blocks of all documents, ranges of doc_id per part."""
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (need(docs, "doc_id", "text")
               .repartitionByRange(parts, "doc_id", F.xxhash64("text"))
               .sortWithinPartitions("doc_id", F.xxhash64("text"), "text"))
    end = np.array([end_id], "<u4").tobytes()

    def run(source):
        part, block, first = TaskContext.get().partitionId(), 0, 0
        ids, names, sizes, held = [], [], [], 0

        def close():
            words, frames, escapes = simple8b.encode(np.frombuffer(b"".join(ids), "<u4"))
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "block": pa.array([block], pa.int64()),
                "first": pa.array([first], pa.int64()),
                "doc_ids": pa.array([names], pa.list_(pa.int64())), "lengths": pa.array([sizes], pa.list_(pa.int64())),
                "words": pa.array([words.astype("<u8").tobytes()], pa.binary()),
                "frame_words": pa.array([frames.astype("<u2").tobytes()], pa.binary()),
                "escapes": pa.array([escapes.astype("<u8").tobytes()], pa.binary())})

        for batch in batches(source):
            coded = encoder(tokenizer).encode(batch.column(1).to_pylist())
            for name, doc in zip(batch.column(0).to_pylist(), coded):
                ids.append(doc + end)
                names.append(name)
                sizes.append(len(doc) // 4 + 1)
                held += sizes[-1]
                if held >= BLOCK_IDS:
                    yield close()
                    block, first = block + 1, first + held
                    ids, names, sizes, held = [], [], [], 0
        if names:
            yield close()

    return ordered.mapInArrow(run, SCHEMA)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, parts: int | None = None) -> None:
    """Write the documents' ids to ``path`` in the format above."""
    prepare(docs.sparkSession)
    encode_blocks(docs, tokenizer, end_id, parts).write.parquet(path)


def part_starts(blocks: DataFrame) -> DataFrame:
    """(part, start): ids of all parts before each part; one row per part."""
    totals = blocks.groupBy("part").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    return totals.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("part_start"))


def read_tokens(blocks: DataFrame) -> DataFrame:
    """One row per document of written blocks: doc_id, start (over all parts), ids (little-endian u32)."""
    joined = blocks.join(part_starts(blocks), "part").select(
        (F.col("part_start") + F.col("first")).alias("start"), "doc_ids", "lengths", "words", "escapes")

    def run(source):
        for batch in batches(source):
            for row in batch.to_pylist():
                ids = simple8b.decode(np.frombuffer(row["words"], "<u8"), np.frombuffer(row["escapes"], "<u8"))
                ids = ids.astype("<u4")
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "start": pa.array(starts + row["start"], pa.int64()),
                    "ids": pa.array([ids[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary())})

    return joined.mapInArrow(run, "doc_id long, start long, ids binary")


def digest(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write the files, read them back: doc_id, start, n_tokens, ids_crc32 of every document."""
    prepare(docs.sparkSession)
    blocks, _ = written(encode_blocks(docs, tokenizer, end_id), "op9")
    return read_tokens(blocks).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"))


__all__ = ["END_ID", "digest", "encode_blocks", "read_tokens", "write_tokens"]
