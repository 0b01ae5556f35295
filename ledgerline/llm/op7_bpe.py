"""Byte-level BPE of whole texts as a reduction over halves of the text.

``encode`` is a homomorphism from texts (under concatenation) to id sequences,
up to a repair at the seam.  A long text is halved recursively down to leaves;
each leaf is encoded alone; two neighbours are joined by re-encoding a window
around their border and keeping the ids outside it.

Why the outside is stable: call a position p *settled* if the character before
it is a letter or digit and the character at p is a space or line feed.  No
match of the split pattern contains p in its inside (a match takes white space
only at its start, or is all white space), so p starts a match in any
encoding of any stretch that holds both characters.  Matching runs from left
to right, looks ahead by no more than the next non-space character, and BPE
works inside a match.  Hence the ids before p depend only on the text up to
and including the character at p, and the ids from p on only on the text from
p on.  The window therefore reaches from the last settled position of the left
half to the first one of the right half; the search grows by doubling, up to a
whole half if it has none.

Decoding concatenates the bytes up the same tree.

Edge cases: a null or empty text has no ids and decodes to no bytes; rows that
repeat a doc_id are separate documents; a null doc_id is kept; an empty table
gives no row; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import batches, need, prepare

#: Characters of a leaf.
LEAF = 8192
#: First size of the search for a settled position.
FIRST_WINDOW = 64

#: A letter or digit before a space or line feed.
_SETTLED = re.compile(r"[^\W_](?=[ \n])")

SCHEMA = "doc_id long, ids array<int>, decoded binary"
_loaded: dict[tuple[str, str], object] = {}


def load(path: str, pattern: str):
    """The rank file as an encoder; one per worker process."""
    if (path, pattern) not in _loaded:
        import tiktoken
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _loaded[path, pattern] = tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _loaded[path, pattern]


def last_settled(text: str, start: int, end: int) -> int:
    """Last settled position in [start, end) by a window that doubles; ``start`` if there is none."""
    size = FIRST_WINDOW
    while True:
        begin = max(start, end - size)
        found = None
        for found in _SETTLED.finditer(text, begin, end):
            pass
        if found:
            return found.end()
        if begin == start:
            return start
        size *= 2


def first_settled(text: str, start: int, end: int) -> int:
    """First settled position in [start, end); ``end`` if there is none."""
    found = _SETTLED.search(text, start, end)
    return found.end() if found else end


def encode_tree(encode, text: str, leaf: int = LEAF) -> list[int]:
    """Ids of ``text`` by halves; ``encode`` gives the ids of a stretch alone."""

    def ids(start: int, end: int) -> list[int]:
        if end - start <= leaf:
            return encode(text[start:end])
        middle = (start + end) // 2
        return join(ids(start, middle), ids(middle, end), start, middle, end)

    def join(left: list[int], right: list[int], start: int, middle: int, end: int) -> list[int]:
        a = last_settled(text, start, middle)
        b = first_settled(text, middle, end)
        dropped = len(encode(text[a:middle]))
        skipped = len(encode(text[middle:b]))
        return left[:len(left) - dropped] + encode(text[a:b]) + right[skipped:]

    return ids(0, len(text))


def decode_tree(decode, ids: list[int], leaf: int = LEAF) -> bytes:
    """Bytes of ``ids``, concatenated up the tree of halves."""
    if len(ids) <= leaf:
        return decode(ids)
    middle = len(ids) // 2
    return decode_tree(decode, ids[:middle], leaf) + decode_tree(decode, ids[middle:], leaf)


def encode_documents(docs: DataFrame, path: str, pattern: str, leaf: int = LEAF) -> DataFrame:
    """doc_id, ids and the bytes decoded from them, of every document."""
    prepare(docs.sparkSession)

    def run(source):
        bpe = load(path, pattern)
        for batch in batches(source):
            ids = [encode_tree(bpe.encode_ordinary, t or "", leaf) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0).cast(pa.int64()), "ids": pa.array(ids, pa.list_(pa.int32())),
                "decoded": pa.array([decode_tree(bpe.decode_bytes, x, leaf) for x in ids], pa.binary())})

    return need(docs, "doc_id", "text").mapInArrow(run, SCHEMA)


def digest(docs: DataFrame, path: str, pattern: str, leaf: int = LEAF) -> DataFrame:
    """doc_id, n_tokens and checksums of ids and decoded bytes."""

    def run(source):
        for batch in batches(source):
            offsets = batch.column(1).offsets.to_pylist()
            flat = batch.column(1).values.to_pylist()
            ids = [flat[a:b] for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "n_tokens": pa.array(map(len, ids), pa.int64()),
                "ids_sha256": pa.array(hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in ids),
                "decoded_sha256": pa.array(hashlib.sha256(x.as_py()).hexdigest() for x in batch.column(2))})

    return encode_documents(docs, path, pattern, leaf).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
