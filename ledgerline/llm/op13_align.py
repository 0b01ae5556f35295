"""Cross-tokenizer alignment: which ids of two tokenizers end at the same bytes, over a whole corpus.

Tokenizer A sees a space and the text, B the text, before which it puts the
space itself.  Where a token of A and one of B end at the same byte, both
sequences are cut into groups, and these two tokens are linked (tokens have
bytes, so a group holds one link).  A pair's count is how often it is linked in
the corpus.

1. Each text is encoded twice and aligned by the running byte lengths.
   ``identity`` gives the B id with the same bytes for every A id: a group of one
   token each is regular when B's id is that one.  Regular groups are kept as
   A ids, the links of irregular ones as pairs; rows are written in blocks.
2. Regular groups are counted in vectors as long as A's vocabulary, one per
   task.  Only irregular links are counted as pairs, once per block and pair,
   before they are shuffled.
3. The counts of (A id, B id) are summed, and the largest of each B id marked.
   A row of a document's regular links needs only the vectors (bounded by the
   vocabulary); the counts of the others come back once per block and pair and meet the
   block's rows.

No text is joined or shuffled; a block holds at most ``BLOCK_IDS`` ids of A, or one document.

Edge cases: a text that is null or empty, or whose tokens do not spell the space and
the text (a character that a tokenizer changes), has no tokens: zeros, and
the empty string as its groups; special tokens in a text are plain text; rows that repeat a
doc_id, or are equal, are documents of their own and count each; a null doc_id
is kept; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import batches, drop_written, need, prepare, written
from .tokens import encoder

#: A ids after which a block is closed.
BLOCK_IDS = 1 << 19

ALIGNED = ("block long, doc_id long, n_a long, n_b long, n_groups long, groups string, "
           "regular binary, odd_a binary, odd_b binary")
PAIRS = "block long, a int, b int, n long"
RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
          "groups_sha256 string")


def identity(a_bytes: list[bytes], b_bytes: list[bytes], b_is_byte: list[bool]) -> np.ndarray:
    """For every A id the B id with the same bytes (a piece before a fallback byte, the smaller id first), or -1."""
    of: dict[bytes, int] = {}
    for i in sorted(range(len(b_bytes)), key=lambda i: (b_is_byte[i], i)):
        if b_bytes[i]:
            of.setdefault(b_bytes[i], i)
    return np.array([of.get(x, -1) for x in a_bytes], np.int64)


class Aligner:
    """Groups and links of texts under two tokenizers."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = encoder(a_path), encoder(b_path)
        a, b = self.a.token_bytes(), self.b.token_bytes()
        self.same = identity(a, b, [self.b.model.is_byte(i) for i in range(len(b))])
        self.a_bytes, self.b_bytes = a, b
        #: How an id is written in ``groups``: within a group, and as the last of its side.
        self.text = [f"{i}{end}" for i in range(len(a)) for end in ",|"] + [f"{i}{end}" for i in range(len(b)) for end in ",;"]
        self.b_first = 2 * len(a)

    def spelled(self, ids: list[int], tokens: list[bytes], want: bytes) -> bool:
        return b"".join(map(tokens.__getitem__, ids)) == want

    def align(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(last A token of each group, last B token, whether the group is regular, codes of ``groups``)."""
        a_end, b_end = np.cumsum(self.a.id_bytes[a]), np.cumsum(self.b.id_bytes[b])
        at = np.searchsorted(b_end, a_end)
        last_a = np.flatnonzero(b_end[at] == a_end)
        last_b = at[last_a]
        regular = (np.diff(last_a, prepend=-1) == 1) & (np.diff(last_b, prepend=-1) == 1)
        regular &= self.same[a[last_a]] == b[last_b]
        end_a, end_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        end_a[last_a], end_b[last_b] = 1, 1
        group_a = np.cumsum(end_a) - end_a
        group_b = np.cumsum(end_b) - end_b
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + np.append(0, last_b + 1)[group_a]] = 2 * a.astype(np.int64) + end_a
        codes[np.arange(len(b)) + (last_a + 1)[group_b]] = self.b_first + 2 * b.astype(np.int64) + end_b
        return last_a, last_b, regular, codes

    def groups(self, codes: np.ndarray) -> str:
        """The groups as text: A ids, a bar, B ids; groups parted by semicolons."""
        return "".join(map(self.text.__getitem__, codes.tolist()))[:-1]


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """One aligner per worker process."""
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


def align_rows(docs: DataFrame, a_path: str, b_path: str, block_ids: int = BLOCK_IDS, whole: bool = True) -> DataFrame:
    """Every row's numbers of tokens and groups, its groups (their sha256 unless ``whole``), and its links.

    ``regular`` are the A ids of regular groups, ``odd_a`` and ``odd_b`` the ids of the other
    links, all as unsigned 32-bit integers; ``block`` numbers runs of rows.
    """

    def run(source):
        tool = aligner(a_path, b_path)
        block, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches(source):
            out = {k: [] for k in ("block", "n_a", "n_b", "n_groups", "groups", "regular", "odd_a", "odd_b")}
            texts = batch.column(1).to_pylist()
            flat_a, count_a = tool.a.encode_flat([" " + t if t else None for t in texts])
            flat_b, count_b = tool.b.encode_flat(texts)
            to_a, to_b = np.cumsum(count_a), np.cumsum(count_b)
            for i, text in enumerate(texts):
                a, b = flat_a[to_a[i] - count_a[i]:to_a[i]], flat_b[to_b[i] - count_b[i]:to_b[i]]
                want = b" " + text.encode() if text else b""
                if not (text and tool.spelled(a.tolist(), tool.a_bytes, want) and tool.spelled(b.tolist(), tool.b_bytes, want)):
                    a, b = a[:0], b[:0]
                if len(a):
                    last_a, last_b, regular, codes = tool.align(a, b)
                    found = tool.groups(codes)
                    links_a, links_b = a[last_a], b[last_b]
                    if not whole:
                        found = hashlib.sha256(found.encode()).hexdigest()
                else:
                    found, regular = "", np.zeros(0, bool)
                    links_a = links_b = np.zeros(0, np.uint32)
                if held >= block_ids:
                    block, held = block + 1, 0
                held += len(a)
                out["block"].append(block)
                out["n_a"].append(len(a))
                out["n_b"].append(len(b))
                out["n_groups"].append(len(regular))
                out["groups"].append(found)
                out["regular"].append(links_a[regular].astype("<u4").tobytes())
                out["odd_a"].append(links_a[~regular].astype("<u4").tobytes())
                out["odd_b"].append(links_b[~regular].astype("<u4").tobytes())
            kinds = dict.fromkeys(("block", "n_a", "n_b", "n_groups"), pa.int64()) | dict.fromkeys(
                ("regular", "odd_a", "odd_b"), pa.binary()) | {"groups": pa.string()}
            columns = {k: pa.array(v, kinds[k]) for k, v in out.items()}
            yield pa.RecordBatch.from_pydict(
                {"block": columns.pop("block"), "doc_id": batch.column(0).cast(pa.int64())} | columns)

    return need(docs, "doc_id", "text").mapInArrow(run, ALIGNED)


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(unsigned 32-bit integers of all binaries end to end, how many each has)."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), "<u4").astype(np.int64), np.array([len(v) // 4 for v in values], np.int64)


def block_pairs(aligned: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """How often each pair is linked: irregular links per block, regular ones (block -1) from a vector per task."""

    def rows(block: int, key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "block": pa.array(np.full(len(key), block, np.int64)), "a": pa.array((key >> 32).astype(np.int32)),
            "b": pa.array((key & 0xFFFFFFFF).astype(np.int32)), "n": pa.array(n.astype(np.int64))})

    def run(source):
        same = aligner(a_path, b_path).same
        vector = np.zeros(len(same), np.int64)
        block, held = None, []
        for batch in batches(source):
            vector += np.bincount(_numbers(batch.column("regular"))[0], minlength=len(same))
            odd_a, count = _numbers(batch.column("odd_a"))
            key = (odd_a << 32) | _numbers(batch.column("odd_b"))[0]
            blocks = batch.column("block").to_numpy()
            ends = np.cumsum(count)
            for x in np.unique(blocks):
                at = np.flatnonzero(blocks == x)  # a block's rows lie together
                if x != block and held:
                    yield rows(block, *np.unique(np.concatenate(held), return_counts=True))
                    held = []
                block = x
                held.append(key[ends[at[0]] - count[at[0]]:ends[at[-1]]])
        if held:
            yield rows(block, *np.unique(np.concatenate(held), return_counts=True))
        seen = np.flatnonzero(vector)
        yield rows(-1, (seen << 32) | same[seen], vector[seen])

    return aligned.select("block", "regular", "odd_a", "odd_b").mapInArrow(run, PAIRS)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """a, b, count, and whether no other A id is linked with b more often; a B id has at most A's vocabulary of pairs."""
    counts = pairs.groupBy("a", "b").agg(F.sum("n").alias("count"))
    return counts.withColumn("best", F.col("count") == F.max("count").over(W.partitionBy("b")))


def align(docs: DataFrame, a_path: str, b_path: str, block_ids: int = BLOCK_IDS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document row."""
    spark = docs.sparkSession
    prepare(spark)
    aligned, _ = written(align_rows(docs, a_path, b_path, block_ids, whole=False), "op13-aligned")
    pairs, pairs_path = written(block_pairs(aligned, a_path, b_path), "op13-pairs")
    counts, counts_path = written(pair_counts(pairs), "op13-counts")
    odd = pairs.where("block >= 0").select("block", "a", "b").join(counts, ["a", "b"])
    odd, _ = written(odd.select("block", "a", "b", "count", "best"), "op13-odd")
    regular = pairs.where("block < 0").select("a", "b").distinct().join(counts, ["a", "b"])
    held = spark.sparkContext.broadcast(  # one row at most per id of A
        [(r["a"], r["count"], r["best"]) for r in regular.select("a", "count", "best").collect()])
    drop_written(spark, pairs_path, counts_path)

    def run(rows: pa.Table, known: pa.Table) -> pa.Table:
        size = len(aligner(a_path, b_path).same)
        count, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
        if held.value:
            at, n, top = (np.array(x) for x in zip(*held.value))
            count[at], best[at] = n, top
        key = (known.column("a").to_numpy().astype(np.int64) << 32) | known.column("b").to_numpy().astype(np.int64)
        order = np.argsort(key)
        key, odd_count = key[order], known.column("count").to_numpy()[order]
        odd_best = known.column("best").to_numpy()[order].astype(np.int64)

        plain, n_plain = _numbers(rows.column("regular"))
        odd_a, n_odd = _numbers(rows.column("odd_a"))
        links = (odd_a << 32) | _numbers(rows.column("odd_b"))[0]
        place = np.searchsorted(key, links)
        sums = [_sum_of(v[plain], n_plain) + _sum_of(w[place], n_odd) for v, w in ((best, odd_best), (count, odd_count))]
        return pa.table({
            "doc_id": rows.column("doc_id"), "n_a": rows.column("n_a"), "n_b": rows.column("n_b"),
            "n_groups": rows.column("n_groups"), "n_links": pa.array(n_plain + n_odd),
            "n_best": pa.array(sums[0]), "count_sum": pa.array(sums[1]), "groups_sha256": rows.column("groups")})

    return aligned.groupBy("block").cogroup(odd.groupBy("block")).applyInArrow(run, RESULT)


def _sum_of(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``counts`` values."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def pair_table(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """The alignment itself: a, b, count, best of every pair linked in the corpus."""
    prepare(docs.sparkSession)
    aligned, _ = written(align_rows(docs, a_path, b_path, whole=False), "op13-aligned")
    return pair_counts(block_pairs(aligned, a_path, b_path))
