"""Benchmark decontamination by one Aho-Corasick automaton over the normalised test items.

Normalised: A-Z in lower case, words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.  A window is
``WINDOW`` consecutive words of an item; an item of fewer words, but not none, is one window.

1. The items become distinct windows with the ids of the items that hold them (a Spark job).
2. The windows' words are numbered.  A number is written as a few digits of
   base 64, each place with an alphabet of its own, so that a match can only
   start at a word; words of no window are one digit of no alphabet.  The
   automaton runs over these digits: a text of n words has ``places * n`` of them, and
   the end of a match divided by ``places`` is its last word.
3. Each text is scanned once.  Its hit words are the union of all matches;
   their stretches are mapped to character offsets of the original text.

The automaton goes to every task, so its size is bounded: at most ``WINDOWS``
windows.  A benchmark with more of them is dealt to several automata, one scan
each, with the rows written between two scans; results are the same.

Edge cases: a null or empty text and one without words has no windows, as an
item, and no hits, as a document; rows that repeat an item_id count once, with
the windows of all their texts; an item whose id is null hits words and counts as
the item with the empty id; every document row has its own result, so repeated
doc_ids stay; without items nothing is hit; other columns are ignored.
"""

from __future__ import annotations

import itertools
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, drop_written, need, prepare, written

WINDOW = 10
#: Windows of one automaton (about 2 KB each at most in a worker).
WINDOWS = 1 << 16
_BASE = 64
#: The digit of words that no window has.
_NONE = chr(0xFF)

#: A-Z in lower case, every other byte that no word has as a space.
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

HIT = "array<struct<first: long, last: long, start: long, stop: long>>"
FOUND = f"doc_id long, n_words long, hits {HIT}, items array<string>"


def words(text: str | None) -> list[bytes]:
    """The normalised words of a text."""
    return text.encode().translate(_NORMAL).split() if text else []


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """window (its words joined by a space) and the sorted ids of the items that hold it."""

    def run(source):
        for b in batches(source):
            ids, out = [], []
            for name, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = words(text)
                found = {b" ".join(w[i:i + size]).decode() for i in range(max(1, len(w) - size + 1))} if w else ()
                ids += [name] * len(found)
                out += found
            yield pa.RecordBatch.from_pydict({"item": pa.array(ids, pa.string()), "window": pa.array(out, pa.string())})

    named = need(items, "item_id", "text").select(F.coalesce(F.col("item_id").cast("string"), F.lit("")), "text")
    return named.mapInArrow(run, "item string, window string").groupBy("window").agg(
        F.sort_array(F.collect_set("item")).alias("items"))


class Automaton:
    """Windows found in the words of a text."""

    def __init__(self, found: list[tuple[str, list[str]]]):
        import ahocorasick
        split = [w.encode().split() for w, _ in found]
        names = sorted({x for w in split for x in w})
        self.places = 1
        while _BASE ** self.places < len(names):
            self.places += 1
        self.codes = {x: self._code(i) for i, x in enumerate(names)}
        self.none = _NONE * self.places
        self.sizes = [len(w) for w in split]
        self.items = [i for _, i in found]
        self.tree = ahocorasick.Automaton()
        for i, w in enumerate(split):
            self.tree.add_word("".join(map(self.codes.__getitem__, w)), i)
        if found:
            self.tree.make_automaton()

    def _code(self, number: int) -> str:
        """The digits of a word's number; each place has its own characters (all below U+00FF while places < 4)."""
        digits = []
        for place in range(self.places):
            number, digit = divmod(number, _BASE)
            at = place * _BASE + digit
            digits.append(chr(at if at < 0xFF else at + 1))
        return "".join(digits)

    def scan(self, found: list[bytes]) -> tuple[list[int], list[int], set[int]]:
        """(first and last word of each hit stretch, rising and disjoint; windows met)."""
        if not self.sizes or not found:
            return [], [], set()
        coded = "".join(map(self.codes.get, found, itertools.repeat(self.none)))
        first, last, met = [], [], set()
        for end, window in self.tree.iter(coded):
            at = end // self.places
            begin = at - self.sizes[window] + 1
            met.add(window)
            while first and begin <= last[-1] + 1:  # ends never fall, so earlier stretches that touch are taken in
                begin = min(begin, first.pop())
                last.pop()
            first.append(begin)
            last.append(at)
        return first, last, met


def word_places(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Character offsets (start, stop) of every normalised word of the original text."""
    raw = np.frombuffer(text.encode(), np.uint8)
    inside = np.frombuffer(_NORMAL, np.uint8)[raw] != 32
    edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return chars[np.flatnonzero(edge == 1)], chars[np.flatnonzero(edge == -1)]


def _merged(a: list[dict], first: list[int], last: list[int]) -> tuple[list[int], list[int]]:
    """The union of earlier stretches and new ones."""
    out_first, out_last = [], []
    for f, s in sorted([*((x["first"], x["last"]) for x in a), *zip(first, last)]):
        if out_first and f <= out_last[-1] + 1:
            out_last[-1] = max(out_last[-1], s)
        else:
            out_first.append(f)
            out_last.append(s)
    return out_first, out_last


_built: dict[str, Automaton] = {}  # a worker's last automaton


def scan(docs: DataFrame, items: DataFrame, size: int = WINDOW, bound: int = WINDOWS,
         with_text: bool = True) -> DataFrame:
    """doc_id, n_words, hits and items (and text) of every document row.

    ``hits`` are the stretches of hit words: numbers of the first and last
    word, and character offsets in the original text.  ``items`` are the ids of
    the items with a window in the text, as sorted strings.
    """
    spark = docs.sparkSession
    prepare(spark)
    table, path = written(windows(items, size), "op11-windows")
    automata = max(1, -(-table.count() // bound))
    rows = need(docs, "doc_id", "text").select(
        "doc_id", "text", F.lit(0).cast("long").alias("n_words"), F.lit(None).cast(HIT).alias("hits"),
        F.lit(None).cast("array<string>").alias("items"))
    before = None
    for turn in range(automata):
        part = table.where(F.pmod(F.xxhash64("window"), F.lit(automata)) == turn) if automata > 1 else table
        held = spark.sparkContext.broadcast([(r["window"], r["items"]) for r in part.collect()])  # about ``bound`` rows
        more = turn < automata - 1
        text = more or with_text
        rows = rows.mapInArrow(_scanner(held, text), FOUND + (", text string" if text else ""))
        if more:
            rows, path_now = written(rows, "op11-scanned")
            if before:
                drop_written(spark, before)
            before = path_now
    drop_written(spark, path)
    return rows


def _scanner(held, with_text: bool):
    name = uuid.uuid4().hex

    def run(source):
        if name not in _built:
            _built.clear()
            _built[name] = Automaton(held.value)
        automaton = _built[name]
        for b in batches(source):
            texts = b.column("text")
            count, hits, items = [], [], []
            for text, old, known in zip(texts.to_pylist(), b.column("hits").to_pylist(), b.column("items").to_pylist()):
                found = words(text)
                first, last, met = automaton.scan(found)
                count.append(len(found))
                if first:
                    first, last = _merged(old or [], first, last)
                    start, stop = word_places(text)
                    old = [{"first": f, "last": s, "start": int(start[f]), "stop": int(stop[s])}
                           for f, s in zip(first, last)]
                hits.append(old or [])
                items.append(sorted({*(known or ()), *(i for w in met for i in automaton.items[w])}))
            out = {"doc_id": b.column("doc_id"), "n_words": pa.array(count, pa.int64()),
                   "hits": pa.array(hits, pa.list_(pa.struct([(k, pa.int64()) for k in ("first", "last", "start", "stop")]))),
                   "items": pa.array(items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_pydict(out | ({"text": texts} if with_text else {}))

    return run


def clean(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without a hit word, all columns as they are."""
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    hit = scan(docs, items, size).where(F.size("hits") > 0).select(F.xxhash64("text").alias("__hit")).distinct()
    return docs.join(hit, key == hit["__hit"], "left_anti")


def digest(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document row."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, x: n + x["last"] - x["first"] + 1)
    return scan(docs, items, size, with_text=False).select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"))


#: DuckDB: windows of each item length looked up among the documents' windows.
ORACLE_SQL = f"""
WITH n AS (
    SELECT *, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM (SELECT 'd' AS kind, doc_id AS id, text, row_number() OVER () AS row FROM documents
          UNION ALL SELECT 'i', item_id, text, 0 FROM benchmark)
), i AS (
    SELECT coalesce(id::VARCHAR, '') AS item, w, least({WINDOW}, len(w)) AS size FROM n WHERE kind = 'i' AND len(w) > 0
), v AS (
    SELECT DISTINCT item, size, list_slice(w, k, k + size - 1) AS words FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS k FROM i)
), p AS (
    SELECT row, s.size, k, list_slice(w, k, k + s.size - 1) AS words
    FROM (SELECT row, w, unnest(range(1, len(w) + 1)) AS k FROM n WHERE kind = 'd') d, (SELECT DISTINCT size FROM v) s
    WHERE k + s.size - 1 <= len(w)
), m AS (
    SELECT row, p.size, k, item FROM p JOIN v ON p.size = v.size AND p.words = v.words
), h AS (
    SELECT row, count(DISTINCT x) AS n_hit FROM (SELECT row, unnest(range(k, k + size)) AS x FROM m) GROUP BY row
), j AS (
    SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT row, item FROM m) GROUP BY row
)
SELECT id AS doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM n LEFT JOIN h USING (row) LEFT JOIN j USING (row) WHERE kind = 'd'"""
