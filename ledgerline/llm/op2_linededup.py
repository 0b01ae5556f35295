"""Line deduplication by pairwise alignment: patience diff of overlapping documents.

1. A text is cut into stretches of words: at line ends, and inside lines where
   the hash of two neighbouring words is less than that of the borders beside it
   (every third border or so), so a passage is cut alike wherever it stands.  Characters of scripts written
   without spaces count as words.  White space between words is not compared.
2. Anchors are runs of neighbouring stretches, within a line or over several,
   of at least ``RUN_WORDS`` words (one from every stretch, as short as can be),
   and whole lines of at least ``MIN_WORDS`` words.  Equal anchors are never
   chance, whatever their frequency, so no frequency cap is needed.
3. To find pairs, every whole line and, of any ``WINDOW`` neighbouring runs, the
   one of least hash stand for the text: a passage that holds so many runs has the
   same least ones wherever it stands.  Each document is paired with the first
   document that holds one of these.  A passage in n documents gives n - 1 pairs,
   not n^2, and every such anchor of a later document is covered by a pair.
4. A pair is aligned by patience diff over the stretches that both hold: those
   unique in both documents, in their longest common rising order, split the pair into gaps
   that are aligned the same way; equal stretches next to a border join it.
5. Aligned stretches that follow each other in both documents form a block.
   All anchors that the pair shares, and blocks that touch one, are deleted from the later
   document.  Words beside a passage that share a stretch with host text stay.

The first holder of a passage keeps it, as no earlier document has it.  Documents
are ordered by doc_id, and different texts of one doc_id by a hash of the text.

Edge cases: a null text stays null; empty lines are never anchors but go with a
block that surrounds them; a document whose lines are all deleted keeps its row
with an empty text.  Rows that repeat a doc_id with the same text are all
trimmed alike; different texts of one doc_id are documents of their own.
A null doc_id is left as it is.
An empty table gives no row.  All other columns are kept, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SEGMENT, batches, drop_written, hash_spans, mix, prepare, text_buffer, token_spans, written

#: Words that make a line an anchor.
MIN_WORDS = 8
#: Most words of a stretch.
LONGEST = 8
#: Words that make a run of stretches an anchor.
RUN_WORDS = 20
#: Neighbouring runs of which the one of least hash is looked up.
WINDOW = 4
#: Marks the first stretch of a line in its shape byte; the rest is its number of words.
LINE_START = 128
#: Bytes of a stretch's hash that are compared within a pair.
VALUE_BYTES = 6
#: Low bits of a hash by which those of two batches are told apart before they are searched.
MARK_BITS = 20


def unique_common(a: list, b: list, a0: int, a1: int, b0: int, b1: int) -> list[tuple[int, int]]:
    """Lines that occur once in either stretch, as a longest common rising sequence of (place in a, place in b)."""
    place: dict = {}
    for i in range(a0, a1):
        place[a[i]] = -1 if a[i] in place else i
    twice: dict = {}
    for j in range(b0, b1):
        twice[b[j]] = b[j] in twice
    pairs = [(place[b[j]], j) for j in range(b0, b1) if not twice[b[j]] and place.get(b[j], -1) >= 0]
    tops: list[int] = []  # patience piles, by place in a
    last: list[int] = []
    before: list[int] = []
    for k, (i, _) in enumerate(pairs):
        pile = bisect_left(tops, i)
        before.append(last[pile - 1] if pile else -1)
        tops[pile:pile + 1] = [i]
        last[pile:pile + 1] = [k]
    out = []
    k = last[-1] if last else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned places of two line sequences, rising in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        anchors = unique_common(a, b, a0, a1, b0, b1) if a0 < a1 and b0 < b1 else []
        if not anchors:
            continue
        out += anchors
        edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:]) if i + 1 < k and j + 1 < m]
    return sorted(out)


def doomed_stretches(a: list, b: list, spans: list[tuple[int, int]], at_a: list, at_b: list) -> list[int]:
    """Places in the later text of shared anchors (``spans``: first and last place), and of aligned blocks that touch one.

    ``a`` and ``b`` are the stretches that both texts hold, ``at_a`` and ``at_b`` their places.
    """
    out = {j for first, last in spans for j in range(first, last + 1)}
    block: list[int] = []
    aligned = [(at_a[i], at_b[j]) for i, j in patience(a, b)]
    more: list[int] = []
    for (i, j), after in zip(aligned, [*aligned[1:], (-1, -1)]):
        block.append(j)
        if after != (i + 1, j + 1):
            if not out.isdisjoint(block):
                more += block
            block = []
    return sorted(out.union(more))


def stretches(column: pa.Array):
    """Of all stretches end to end: start and end byte, hash, words, number of their line; and stretches per text."""
    data, offsets = text_buffer(column)
    starts, ends, counts = token_spans(data, offsets)
    n = len(starts)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, np.uint64), z, z, np.zeros(len(counts), np.int64)
    word = hash_spans(data, starts, ends)
    text = np.repeat(np.arange(len(counts)), counts)
    line = np.concatenate([[0], np.cumsum(data == 10)])[starts]
    first = np.ones(n, bool)
    # inside a line: borders whose hash is less than those of the borders beside them
    border = mix(word[:-1] * np.uint64(0x9E3779B97F4A7C15) + word[1:])
    least = np.zeros(n - 1, bool)
    # both borders beside it in the same text, so that a text is cut alike in any batch
    least[1:-1] = (border[1:-1] < border[:-2]) & (border[1:-1] < border[2:]) & (text[:-3] == text[3:])
    first[1:] = (text[1:] != text[:-1]) | (line[1:] != line[:-1]) | least
    at = np.flatnonzero(first)
    first |= (np.arange(n) - np.repeat(at, np.diff(np.append(at, n)))) % LONGEST == 0  # one word over and over
    at = np.flatnonzero(first)
    size = np.diff(np.append(at, n))
    place = (np.arange(n) - np.repeat(at, size)).astype(np.uint64)
    value = mix(np.add.reduceat(mix(word + place * np.uint64(0xD6E8FEB86659FD93)), at) + size.astype(np.uint64))
    per = np.bincount(text[at], minlength=len(counts))
    # lines are told apart across texts too: texts need not end in a line feed
    return starts[at], ends[at + size - 1], value, size, line[at] + text[at], per


def anchor_spans(value: np.ndarray, size: np.ndarray, line: np.ndarray, per: np.ndarray):
    """First and last place (over all texts) and hash of each anchor, runs of RUN_WORDS words before whole lines; number of runs."""
    n = len(value)
    text_end = np.repeat(np.cumsum(per), per)
    words = np.concatenate([[0], np.cumsum(size)])
    of_word = np.repeat(np.arange(n), size)  # stretch of each word
    run_end = np.full(n, n + 1)  # one past the last stretch
    enough = words[:-1] + RUN_WORDS <= words[-1]
    run_end[enough] = of_word[words[:-1][enough] + (RUN_WORDS - 1)] + 1
    run = np.flatnonzero(run_end <= text_end)
    edge = np.flatnonzero(np.diff(line, prepend=-1))
    line_end = np.append(edge[1:], n)[:len(edge)]
    long = words[line_end] - words[edge] >= MIN_WORDS
    first = np.concatenate([run, edge[long]])
    last = np.concatenate([run_end[run], line_end[long]]) - 1
    kind = np.repeat(np.array([1, 2], np.uint64), [len(run), int(long.sum())])
    if not len(first):
        return first, last, np.zeros(0, np.uint64), 0
    # hash of a run: its stretches and their places in it
    room = last - first + 1
    begin = np.cumsum(room) - room
    inside = np.arange(int(room.sum())) - np.repeat(begin, room)
    part = mix(value[np.repeat(first, room) + inside] + inside.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    return first, last, mix(np.add.reduceat(part, begin) + kind), len(run)


def looked_up(first: np.ndarray, anchor: np.ndarray, runs: int, per: np.ndarray) -> np.ndarray:
    """Which anchors stand for their text: whole lines, and of any WINDOW neighbouring runs the one of least hash.

    The first ``runs`` anchors are runs; a text of fewer than WINDOW runs has one window.
    """
    out = np.ones(len(first), bool)
    text = np.searchsorted(np.cumsum(per), first[:runs], "right")
    h = anchor[:runs]
    out[:runs] = False
    windows = runs - WINDOW + 1
    if windows > 0:
        least = h[:windows].copy()
        for d in range(1, WINDOW):
            np.minimum(least, h[d:d + windows], out=least)
        whole = text[:windows] == text[WINDOW - 1:]
        for d in range(WINDOW):
            out[d:d + windows] |= whole & (h[d:d + windows] == least)
    if runs:
        edge = np.flatnonzero(np.diff(text, prepend=-1))
        room = np.diff(np.append(edge, runs))
        few = np.repeat(room < WINDOW, room)
        out[:runs] |= few & (h == np.repeat(np.minimum.reduceat(h, edge), room))
    return out


def _lists(values: np.ndarray, edge: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.array(values, kind))


def _bytes(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary values: bytes ``offsets[i]`` to ``offsets[i + 1]`` of ``data``."""
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32).tobytes()),
                                                                 pa.py_buffer(data.tobytes())])


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all values end to end, bytes per value)."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    return np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]], np.diff(offsets)


def narrow(value: np.ndarray) -> np.ndarray:
    """The low ``VALUE_BYTES`` bytes of each hash, end to end: enough to tell the stretches of two texts apart."""
    return value.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :VALUE_BYTES].ravel()


def wide(data: np.ndarray) -> np.ndarray:
    """The hashes of ``narrow`` bytes."""
    out = np.zeros((len(data) // VALUE_BYTES, 8), np.uint8)
    out[:, :VALUE_BYTES] = data.reshape(-1, VALUE_BYTES)
    return out.view("<u8").ravel().astype(np.uint64)


def _parts(batch: pa.RecordBatch, *sized: int):
    """The batch in slices of about ``SEGMENT`` bytes of the columns ``sized``, one row at least."""
    sizes = sum(pc.binary_length(batch.column(k)).to_numpy().astype(np.int64) for k in sized)
    part = (np.cumsum(sizes) - sizes) // SEGMENT
    edge = [*np.flatnonzero(np.diff(part, prepend=-1)).tolist(), batch.num_rows]
    for i, j in zip(edge, edge[1:]):
        yield pa.RecordBatch.from_arrays([pa.concat_arrays([c.slice(i, j - i)]) for c in batch.columns],
                                         names=batch.schema.names)


def stretch_table(docs: DataFrame) -> DataFrame:
    """doc_id, print (hash of the text), values and shapes of its stretches (bytes), and the anchors that are looked up."""

    def run(source):
        for batch in batches(source):
            _, _, value, size, line, per = stretches(batch.column(2))
            first, _, anchor, runs = anchor_spans(value, size, line, per)
            keep = looked_up(first, anchor, runs, per)
            first, anchor = first[keep], anchor[keep]
            edge = np.concatenate([[0], np.cumsum(per)])
            order = np.argsort(first, kind="stable")
            first, anchor = first[order], anchor[order].view(np.int64)
            new = np.ones(len(first), bool)  # one word over and over has one anchor
            new[1:] = anchor[1:] != anchor[:-1]
            new[np.searchsorted(first, edge[:-1][per > 0]).clip(max=max(len(new) - 1, 0))] = True
            first, anchor = first[new], anchor[new]
            shape = size.astype(np.uint8)
            shape[np.flatnonzero(np.diff(line, prepend=-1))] |= LINE_START
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0).cast(pa.int64()), "print": batch.column(1),
                "value": _bytes(narrow(value), edge * VALUE_BYTES), "shape": _bytes(shape, edge),
                "anchors": _lists(anchor, np.searchsorted(first, edge), pa.int64())})

    return docs.where("doc_id is not null and text is not null").select(
        "doc_id", F.xxhash64("text").alias("print"), "text").mapInArrow(
        run, "doc_id long, print long, value binary, shape binary, anchors array<long>")


def without(data: bytes, starts: list[int], ends: list[int], removed: list[int]) -> str:
    """The text without the stretches ``removed`` (rising) of all its stretches; a line that loses all goes, as do empty lines between such."""
    out: list[tuple[str, bytes]] = []
    k = r = at = 0
    for line in data.split(b"\n"):
        end, first = at + len(line), k
        k = bisect_left(starts, end, k)
        if r < len(removed) and removed[r] < k:
            kept, place = b"", at
            while r < len(removed) and removed[r] < k:
                kept, place = kept + data[place:starts[removed[r]]], ends[removed[r]]
                r += 1
            kept += data[place:end]
            out.append(("kept" if kept.strip() else "gone", kept.rstrip()))
        else:
            out.append(("empty" if k == first else "kept", line))
        at = end + 1
    after, states = "kept", []
    for state, _ in reversed(out):
        after = after if state == "empty" else state
        states.append(after)
    before, lines = "kept", []
    for (state, line), following in zip(out, reversed(states)):
        before = before if state == "empty" else state
        if not (before == following == "gone"):
            lines.append(line)
    return b"\n".join(lines).decode()


def trimmed_texts(column: pa.Array, removed: list[list[int]]) -> list[str]:
    """Each text without its removed stretches."""
    starts, ends, _, _, _, per = stretches(column)
    offsets = text_buffer(column)[1]
    edge = np.concatenate([[0], np.cumsum(per)])
    out = []
    for i, (text, gone) in enumerate(zip(column.to_pylist(), removed)):
        here = slice(edge[i], edge[i + 1])
        out.append(without(text.encode(), (starts[here] - offsets[i]).tolist(), (ends[here] - offsets[i]).tolist(), gone))
    return out


def among(x: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which of the hashes ``x`` are in ``of``."""
    out = np.zeros(len(x), bool)
    if not len(of):
        return out
    # hashes: their low bits rule out most of those that are not, the others are looked up
    held = np.zeros(1 << MARK_BITS, bool)
    low = np.uint64((1 << MARK_BITS) - 1)
    held[of & low] = True
    maybe = np.flatnonzero(held[x & low])
    of = np.sort(of)
    out[maybe] = of[np.searchsorted(of, x[maybe]).clip(max=len(of) - 1)] == x[maybe]
    return out


def doomed(values: tuple[pa.Array, pa.Array], shapes: tuple[pa.Array, pa.Array]) -> list[list[int]]:
    """Of each pair (earlier, later) of texts by their stretches: the places that the later one loses."""
    sides = []
    for value, shape in zip(values, shapes):
        value = wide(_unpacked(value)[0])
        shape, per = _unpacked(shape)
        first, last, anchor, _ = anchor_spans(value, (shape & (LINE_START - 1)).astype(np.int64),
                                              np.cumsum(shape >= LINE_START), per)
        salt = mix(np.arange(len(per), dtype=np.uint64) + np.uint64(1))  # compare within the pair only
        edge = np.concatenate([[0], np.cumsum(per)])
        pair = np.searchsorted(edge, first, "right") - 1
        sides.append((value, mix(value ^ np.repeat(salt, per)), edge, first, last, mix(anchor ^ salt[pair]), pair))
    (value_a, key_a, edge_a, _, _, anchor_a, _), (value_b, key_b, edge_b, first, last, anchor_b, pair) = sides
    common_a, common_b = np.flatnonzero(among(key_a, key_b)), np.flatnonzero(among(key_b, key_a))
    shared = np.flatnonzero(among(anchor_b, anchor_a))
    shared = shared[np.argsort(pair[shared], kind="stable")]
    n = len(edge_a) - 1
    cut_a, cut_b = np.searchsorted(common_a, edge_a), np.searchsorted(common_b, edge_b)
    cut = np.searchsorted(pair[shared], np.arange(n + 1))
    out = []
    for i in range(n):
        at_a, at_b = common_a[cut_a[i]:cut_a[i + 1]], common_b[cut_b[i]:cut_b[i + 1]]
        own = shared[cut[i]:cut[i + 1]]
        spans = list(zip((first[own] - edge_b[i]).tolist(), (last[own] - edge_b[i]).tolist()))
        out.append(doomed_stretches(value_a[at_a].tolist(), value_b[at_b].tolist(), spans,
                                    (at_a - edge_a[i]).tolist(), (at_b - edge_b[i]).tolist()))
    return out


def deletions(docs: DataFrame) -> DataFrame:
    """doc_id, print and removed (places of deleted stretches) of every document that loses any."""
    spark = docs.sparkSession
    texts, path = written(stretch_table(docs), "op2-stretches")
    # where every doc_id has one row, the print need not travel with each anchor; the result is the same
    single = texts.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    texts = texts.withColumn("place", F.col("doc_id") if single else F.struct("doc_id", "print"))
    anchors = texts.select("place", F.explode("anchors").alias("h"))
    holders = anchors.groupBy("h").agg(F.min("place").alias("a"), F.count("*").alias("n")).where("n > 1").select("h", "a")
    # the joins are the same at every size
    pairs = anchors.join(holders.hint("merge"), "h").where(F.col("a") < F.col("place")).select(
        "a", F.col("place").alias("b")).distinct()
    pairs, pairs_path = written(pairs, "op2-pairs")
    used = texts.select("place", "doc_id", "print", "value", "shape")
    if not single:  # rows that repeat a text are aligned once
        used = used.groupBy("place").agg(*[F.first(c).alias(c) for c in ("doc_id", "print", "value", "shape")])
    other = used.select(F.col("place").alias("a"), F.col("value").alias("value_a"), F.col("shape").alias("shape_a"))
    own = used.select(F.col("place").alias("b"), "doc_id", "print", F.col("value").alias("value_b"),
                      F.col("shape").alias("shape_b"))
    joined = pairs.join(other.hint("merge"), "a").join(own.hint("merge"), "b").select(
        "doc_id", "print", "value_a", "shape_a", "value_b", "shape_b")

    def run(source):
        for batch in batches(source):
            for part in _parts(batch, 2, 4):
                removed = doomed((part.column(2), part.column(4)), (part.column(3), part.column(5)))
                yield pa.RecordBatch.from_pydict({"doc_id": part.column(0), "print": part.column(1),
                                                  "removed": pa.array(removed, pa.list_(pa.int32()))})

    found = joined.mapInArrow(run, "doc_id long, print long, removed array<int>")
    found = found.groupBy("doc_id", "print").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("removed")))).alias("removed"))
    found, _ = written(found, "op2-removed")
    drop_written(spark, path, pairs_path)
    return found


def _unused(names: list[str], name: str) -> str:
    """``name``, longer until no column has it."""
    taken = {n.lower() for n in names}
    while name in taken:
        name = "_" + name
    return name


def dedup_lines(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the documents without deleted stretches, the deletions)."""
    prepare(docs.sparkSession)
    found = deletions(docs)
    names = docs.columns
    at = names.index("text")
    id_, print_, gone_ = (_unused(names, x) for x in ("found_id", "found_print", "found_removed"))
    gone = found.select(F.col("doc_id").alias(id_), F.col("print").alias(print_), F.col("removed").alias(gone_))
    joined = docs.join(gone, (docs["doc_id"] == gone[id_]) & (F.xxhash64(docs["text"]) == gone[print_]), "left").select(
        *[docs[c] for c in names], gone_)

    def run(source):
        for batch in batches(source):
            removed = batch.column(len(names))
            column = batch.column(at)
            rows = np.flatnonzero(np.array(removed.is_valid()))
            if len(rows):
                texts = column.to_pylist()
                new = trimmed_texts(column.take(pa.array(rows)), removed.take(pa.array(rows)).to_pylist())
                for i, text in zip(rows.tolist(), new):
                    texts[i] = text
                column = pa.array(texts, column.type)
            columns = [column if i == at else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return joined.mapInArrow(run, docs.schema), found


def report(docs: DataFrame) -> DataFrame:
    """doc_id, removed_lines (deleted stretches), kept_chars and text_crc32 of every document after deletion."""
    trimmed, found = dedup_lines(docs.select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    # figures before the join, so that no text is shuffled a second time
    figures = trimmed.select("doc_id", F.length(text).cast("long").alias("kept_chars"),
                             F.crc32(text.cast("binary")).alias("text_crc32"))
    return figures.join(found.select("doc_id", F.size("removed").alias("n")), "doc_id", "left").select(
        "doc_id", F.coalesce("n", F.lit(0)).cast("long").alias("removed_lines"), "kept_chars", "text_crc32")
