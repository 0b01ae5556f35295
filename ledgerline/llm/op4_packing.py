"""Packing of documents' token ids into sequences of one window, by non-negative least squares.

1. Tokenise every document (plus an end id) into a written table.
2. Cut each document into whole windows and one remainder (shorter than the
   window, so the histogram of remainders has fewer bins than the window).
3. Enumerate shallow combinations of lengths (at most three pieces) that fill a
   window exactly, solve their repeat counts against the histogram by
   non-negative least squares, round down within the histogram.
4. Pack the residual remainders greedily: end to end, cut at window borders;
   what is left of the last window is split at powers of two.

The plan has at most a few thousand rows whatever the table's size.  A piece's
place follows from its document's rank among remainders of equal length: a rank
within the part (kept while tokenising) plus the counts of earlier parts, so no
length, however frequent, is ever gathered in one task.

Edge cases: a null or empty text is the end id alone.  Rows that repeat a
doc_id, a null doc_id and equal texts are packed like any other row.  An empty
table gives no piece.  Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import batches, need, prepare, written
from .tokens import encoder

WINDOW = 1024
END_ID = 0
#: Combinations of three pieces are enumerated for this many of the most frequent lengths.
TRIPLE_LENGTHS = 128
NNLS_STEPS = 400
#: Largest table of offsets (bytes) that is sent to every executor; beyond it the join shuffles.
BROADCAST_BYTES = 64 << 20

TOKENS = "part int, doc_id long, ids binary, n_tokens long, rest int, place long, windows_before long"
PIECES = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, `offset` long, "
          "ids binary")


def tokenise(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Ids of each document with its rank within the part: among remainders of its length, and in whole windows."""
    end = np.array([end_id], "<u4").tobytes()

    def run(source):
        part = TaskContext.get().partitionId()
        seen = np.zeros(window, np.int64)
        windows = 0
        for batch in batches(source):
            ids = [x + end for x in encoder(tokenizer).encode(batch.column(1).to_pylist())]
            n = np.array([len(x) // 4 for x in ids])
            rest = n % window
            order = np.argsort(rest, kind="stable")
            run_start = np.searchsorted(rest[order], rest[order])
            place = np.empty(len(n), np.int64)
            place[order] = np.arange(len(n)) - run_start
            place += seen[rest]
            seen += np.bincount(rest, minlength=window)
            whole = n // window
            before = windows + np.cumsum(whole) - whole
            windows += int(whole.sum())
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(np.full(len(n), part, np.int32)), "doc_id": batch.column(0).cast(pa.int64()),
                "ids": pa.array(ids, pa.binary()), "n_tokens": pa.array(n.astype(np.int64)),
                "rest": pa.array(rest.astype(np.int32)), "place": pa.array(place),
                "windows_before": pa.array(before.astype(np.int64))})

    return need(docs, "doc_id", "text").mapInArrow(run, TOKENS)


def combinations(histogram: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Rows of three lengths (ascending, 0: no piece) that fill the window, all present in the histogram."""
    have = np.flatnonzero(histogram)
    have = have[have > 0]
    pairs = [(0, a, window - a) for a in have if a <= window - a and histogram[window - a]]
    top = np.sort(have[np.argsort(-histogram[have], kind="stable")][:TRIPLE_LENGTHS])
    a, b = np.meshgrid(top, top, indexing="ij")
    c = window - a - b
    fits = (a <= b) & (b <= c)
    fits[fits] &= histogram[c[fits]] > 0
    triples = np.stack([a[fits], b[fits], c[fits]], 1)
    return np.concatenate([np.array(pairs, np.int64).reshape(-1, 3), triples.astype(np.int64)])


def solve_repeats(combos: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """Repeat counts x >= 0 minimising |A x - histogram| (projected gradient with momentum), rounded to fit.

    A[l, c] is how often combination c uses length l.  Rounding goes down, and a
    combination never takes more pieces of a length than are left.
    """
    if not len(combos):
        return np.zeros(0, np.int64)
    goal = histogram.astype(float)
    goal[0] = 0
    size = len(goal)

    def used(x):
        y = np.bincount(combos.ravel(), np.repeat(x, 3), size)
        y[0] = 0
        return y

    # largest eigenvalue of A'A by power iteration, for the step size
    v = np.ones(len(combos))
    for _ in range(30):
        v = used(v)[combos].sum(1)
        top = np.linalg.norm(v)
        v /= top
    x = z = np.zeros(len(combos))
    t = 1.0
    for _ in range(NNLS_STEPS):
        slope = np.where(combos > 0, (used(z) - goal)[combos], 0).sum(1)
        new = np.maximum(0, z - slope / (1.1 * top))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, x, t = new + (t - 1) / t_new * (new - x), new, t_new
    left = histogram.astype(np.int64).copy()
    left[0] = np.iinfo(np.int64).max // 2
    counts = np.zeros(len(combos), np.int64)
    for want in (np.floor(x), np.ceil(x)):
        for c in np.argsort(-x, kind="stable"):
            kinds, times = np.unique(combos[c][combos[c] > 0], return_counts=True)
            take = int(min(want[c] - counts[c], (left[kinds] // times).min()))
            if take > 0:
                counts[c] += take
                left[kinds] -= take * times
    return counts


class Plan:
    """Where the r-th remainder of each length goes; sequence ids start at 0."""

    def __init__(self, histogram: np.ndarray, window: int = WINDOW):
        self.window = window
        combos = combinations(histogram, window)
        counts = solve_repeats(combos, histogram)
        used = counts > 0
        combos, counts = combos[used], counts[used]
        base = np.concatenate([[0], np.cumsum(counts)])
        self.ranges: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        rows: dict[int, list[tuple[int, int, int]]] = {}
        for c, (lengths, count) in enumerate(zip(combos, counts)):
            offset = 0
            for length in lengths[lengths > 0]:
                rows.setdefault(int(length), []).append((int(count), int(base[c]), offset))
                offset += int(length)
        planned = np.zeros(window, np.int64)
        for length, found in rows.items():
            n, first, offset = np.array(found).T
            self.ranges[length] = (np.concatenate([[0], np.cumsum(n)]), first, offset)
            planned[length] = n.sum()
        self.planned = planned
        self.sequences = int(base[-1])
        rest = (histogram - planned) * np.arange(window)
        rest[0] = 0
        self.stream = np.concatenate([[0], np.cumsum(rest)])  # where each length's residuals start
        self.total = int(self.stream[-1])
        tail = self.total % window
        self.borders = []  # of the last, partial window
        at = self.total - tail
        for bit in reversed(range(window.bit_length() - 1)):
            if tail >> bit & 1:
                self.borders.append(at)
                at += 1 << bit
        self.whole = (self.total - tail) // window
        self.end = self.sequences + self.whole + len(self.borders)  # whole windows of documents follow

    def place(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(from, pieces' length, sequence, offset) of the rank-th remainder of this length."""
        if rank < self.planned[length]:
            edges, first, offset = self.ranges[length]
            i = int(np.searchsorted(edges, rank, "right")) - 1
            return [(0, length, int(first[i] + rank - edges[i]), int(offset[i]))]
        at = int(self.stream[length] + (rank - self.planned[length]) * length)
        out, done = [], 0
        while done < length:
            if at < self.whole * self.window:
                sequence, begin = self.sequences + at // self.window, at // self.window * self.window
                border = begin + self.window
            else:
                k = int(np.searchsorted(self.borders, at, "right")) - 1
                sequence, begin = self.sequences + self.whole + k, self.borders[k]
                border = self.borders[k + 1] if k + 1 < len(self.borders) else self.total
            size = min(length - done, border - at)
            out.append((done, size, sequence, at - begin))
            done, at = done + size, at + size
        return out


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (little-endian u32)."""
    spark = docs.sparkSession
    prepare(spark)
    tokens, _ = written(tokenise(docs, tokenizer, window, end_id), "op4")
    by_part = tokens.groupBy("part", "rest").agg(
        F.count("*").alias("n"), F.sum(F.floor(F.col("n_tokens") / window)).alias("whole"))
    by_part, _ = written(by_part, "op4-parts")
    histogram = np.zeros(window, np.int64)
    for r in by_part.groupBy("rest").agg(F.sum("n").alias("n")).collect():  # at most one row per length
        histogram[r["rest"]] = r["n"]
    plan = Plan(histogram, window)

    # ranks of earlier parts: one row per part, at most ``window`` entries each
    before = W.partitionBy("rest").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    ranks = by_part.select("part", "rest", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier")).groupBy(
        "part").agg(F.map_from_entries(F.collect_list(F.struct("rest", "earlier"))).alias("earlier"))
    totals = by_part.groupBy("part").agg(F.sum("whole").alias("whole"))
    totals = totals.select("part", F.coalesce(F.sum("whole").over(
        W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("windows_earlier"))
    offsets = ranks.join(totals, "part")
    parts = by_part.agg(F.countDistinct("part")).first()[0]
    if parts * window * 12 <= BROADCAST_BYTES:
        offsets = F.broadcast(offsets)
    joined = tokens.join(offsets, "part").select(
        "doc_id", "ids", "n_tokens", "rest",
        (F.col("place") + F.col("earlier")[F.col("rest")]).alias("rank"),
        (F.col("windows_before") + F.col("windows_earlier")).alias("first_window"))

    def run(source):
        for batch in batches(source):
            out = {k: [] for k in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids")}
            for doc_id, ids, n, rest, rank, first in zip(*(c.to_pylist() for c in batch.columns)):
                whole = n // window
                places = [(k * window, window, plan.end + first + k, 0) for k in range(whole)]
                if rest:
                    places += [(whole * window + a, size, s, o) for a, size, s, o in plan.place(rest, rank)]
                for start, size, sequence, offset in places:
                    out["doc_id"].append(doc_id)
                    out["start"].append(start)
                    out["length"].append(size)
                    out["doc_tokens"].append(n)
                    out["sequence_id"].append(sequence)
                    out["offset"].append(offset)
                    out["ids"].append(ids[start * 4:(start + size) * 4])
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.binary() if k == "ids" else pa.int64())
                                              for k, v in out.items()})

    return joined.mapInArrow(run, PIECES)


def digest(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pack(docs, tokenizer).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
