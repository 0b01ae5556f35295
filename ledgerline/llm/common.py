"""Shared helpers: written hand-offs, and vectorised words, shingles and lines of Arrow text."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import ensure_checkpoint_dir, scratch_path

#: Rows per Arrow batch sent to Python: long texts stay a few MB a batch.
BATCH_ROWS = 512
#: Bytes of columns that are worked on at a time.
SEGMENT = 1 << 20
#: Bytes of text hashed at a time: their sums stay in a core's cache.
HASH_SEGMENT = 1 << 15


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches (texts may be long), a checkpoint folder, and this package on the workers' path.

    On a cluster the package is shipped as any other (``--py-files``); the path
    serves workers that share the driver's file system, as in local mode.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*filter(None, known), root])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    ensure_checkpoint_dir(spark)


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` to a fresh folder under the shared checkpoint folder and read it back.

    This cuts lineage: a lost executor costs only the tasks that read the table.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_written(spark: SparkSession, *paths: str) -> None:
    """Remove hand-off folders that no result reads any more."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def need(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, each once, whatever else ``df`` carries."""
    return df.select(*[F.col(c) for c in columns])


# ---------------------------------------------------------------- words

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_powers: list[np.ndarray] = []
_C = [np.uint64(c) for c in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
                             0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * _C[0]
    x = x ^ (x >> np.uint64(27))
    x = x * _C[1]
    return x ^ (x >> np.uint64(31))


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        n = max(n, HASH_SEGMENT + 1)
        both = []
        for base in (_BASE, _INVERSE):
            a = np.full(n, base, np.uint64)
            a[0] = 1
            both.append(np.multiply.accumulate(a))
        _powers[:] = both
    return _powers[0], _powers[1]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all texts end to end, n + 1 offsets); a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case; every other byte as it is."""
    return data + (((data >= 65) & (data <= 90)) * np.uint8(32))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words per text) of words ``[^\\x20\\x09-\\x0D]+``; no word spans two texts."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets) - 1, np.int64)
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = offsets[(offsets > 0) & (offsets < n)]
    first[cut] = inside[cut]
    starts = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[cut - 1] = inside[cut - 1]
    ends = np.flatnonzero(last) + 1
    at = np.searchsorted(starts, offsets)
    return starts, ends, np.diff(at)


def token_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, tokens per text): words between white space; characters of unspaced scripts are their own."""
    starts, ends, counts = word_spans(data, offsets)
    if not len(starts):
        return starts, ends, counts
    # most texts hold no lead byte of such a script: E3 to ED, and E0 before B8 to BB
    if not ((data >= 0xE3) & (data <= 0xED)).any():
        second = data[np.flatnonzero(data[:-1] == 0xE0) + 1]
        if not ((second >= 0xB8) & (second <= 0xBB)).any():
            return starts, ends, counts
    lead = (data & 0xC0) != 0x80
    place = np.maximum.accumulate(np.where(lead, np.arange(len(data)), 0))
    first, second = data[place], data[np.minimum(place + 1, len(data) - 1)]
    # Han, kana and Hangul; Thai and Lao
    alone = ((first >= 0xE3) & (first <= 0xED)) | ((first == 0xE0) & (second >= 0xB8) & (second <= 0xBB))
    begins, stops = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
    begins[starts], stops[ends] = True, True
    cut = np.flatnonzero(lead & (alone | np.concatenate([[False], alone[:-1]])))
    inside = np.zeros(len(data) + 1, np.int64)
    np.add.at(inside, starts, 1)
    np.add.at(inside, ends, -1)
    cut = cut[np.cumsum(inside)[cut] > 0]
    begins[cut] = True
    stops[cut[~_among(starts, cut)]] = True
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops)
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def _among(starts: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which of ``at`` are among the sorted ``starts``."""
    return starts[np.minimum(np.searchsorted(starts, at), len(starts) - 1)] == at


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span, equal on every machine."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        a = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, a + HASH_SEGMENT, "right")))
        size = int(ends[j - 1] - a)
        up, down = _power_table(size + 1)
        sums = np.zeros(size + 1, np.uint64)
        part = _BYTE[data[a:a + size]]
        part *= up[:size]
        np.cumsum(part, out=sums[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


def shingles(words: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, windows per text): k-word windows; a shorter text's whole sequence is its one window."""
    n = len(words)
    first = np.concatenate([[0], np.cumsum(counts)])
    windows = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    total = int(windows.sum())
    if not total:
        return np.zeros(0, np.uint64), windows
    begin = np.concatenate([[0], np.cumsum(windows)[:-1]])
    at = np.arange(total) - np.repeat(begin, windows) + np.repeat(first[:-1], windows)
    room = np.repeat(np.minimum(counts, k), windows)
    out = np.zeros(total, np.uint64)
    for j in range(k):
        here = words[np.minimum(at + j, n - 1)]
        out += np.where(room > j, here * _C[j % 6] + _C[(j + 1) % 6], np.uint64(j + 1))
    return mix(out), windows


def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches that hold rows."""
    return (b for b in source if b.num_rows)
