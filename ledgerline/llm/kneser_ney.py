"""Modified Kneser-Ney scores of every token, in packed blocks: the work of ``op6_quality.score``.

Texts are hashed into tokens once; the tokens are written in text order as numbers
of a code book, or as whole 64-bit hashes where the book has none (``tokens``).
Whatever the book holds, results are the same: it only shortens.

A token's trigram (u, v, w) goes to the bucket of its middle word, where its
count, its context's and its pair's figures are all at hand.  A middle word that
fills buckets is dealt to several by u; its pairs are then summed by a hash of
their last word.  Words are summed by a hash of the word.  Buckets are worked through in
up to ``ROUNDS`` rounds, so that only a share of the tokens is on disk at a time:

1. ``first``: each bucket counts counts and asks for the continuation counts of
   its words (and of the pairs of a dealt word), adding what it knows of them.
2. ``sum_pairs`` and ``sum_words`` sum these and reply to every bucket.
3. ``second``: each bucket, sent the same tokens once more, works out their
   probabilities, and sends their logarithms' sums back by passage.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches, drop_written, hash_spans, mix, shingles, text_buffer, token_spans, written

#: Stands before the first word of a text.
BORDER = np.uint64(0x5DEECE66D)
#: Tokens of a written chunk of texts, and of a bucket.
CHUNK = 1 << 20
BUCKET = 3 << 18
#: Most rounds, and least tokens of one.
ROUNDS = 12
ROUND = 1 << 21
#: Words of the code book, and its slots.
BOOK = 1 << 18
SLOTS = 1 << 21
_ODD = np.uint64(0x9E3779B97F4A7C15)
_KINDS = [np.dtype(k) for k in ("u1", "u2", "u4", "u8", "i8", "f8")]

MESSAGE = "kind int, at long, src long, blob binary, s array<double>"
#: Kinds of messages between the stages.
WORD_ASK, STATS, PAIR_ASK, PAIR_REPLY, HOT_STATS, WORD_REPLY, WORD_STATS, TOKENS = range(8)


CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """What is shuffled for a query herein is removed as the query ends."""
    before = spark.conf.get(CLEAN, "false")
    spark.conf.set(CLEAN, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN, before)


def handed(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As ``written``, and what was shuffled for it is removed at once."""
    with cleaned(df.sparkSession):
        return written(df, name)


# ---------------------------------------------------------------- packed arrays

def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value, byte planes apart, without the upper planes that are all zero."""
    head, planes = [len(arrays)], []
    for a in arrays:
        width = a.dtype.itemsize
        if a.dtype.kind == "u":
            width = -(-int(a.max(initial=0)).bit_length() // 8)
        head += [_KINDS.index(a.dtype), len(a), width]
        of = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize)
        planes += [of[:, k].tobytes() for k in range(width)]
    body = b"".join([np.array(head, np.int64).tobytes(), *planes])
    return len(body).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)


def unpacked(blob: bytes) -> list[np.ndarray]:
    view = memoryview(blob)
    body = np.frombuffer(pa.decompress(view[8:], int.from_bytes(view[:8], "little"), codec="zstd"), np.uint8)
    n = int(body[:8].view(np.int64)[0])
    out, at = [], 8 + 24 * n
    for kind, size, width in body[8:at].view(np.int64).reshape(n, 3).tolist():
        dtype = _KINDS[kind]
        of = np.zeros((size, dtype.itemsize), np.uint8)
        for k in range(width):
            of[:, k] = body[at:at + size]
            at += size
        out.append(of.reshape(-1).view(dtype))
    return out


def steps(ascending: np.ndarray) -> np.ndarray:
    """Differences of ascending values, the first one whole."""
    out = ascending.copy()
    out[1:] -= ascending[:-1]
    return out


def _runs(ascending: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts of the runs of equal values, the run of each place)."""
    first = np.ones(len(ascending), bool)
    first[1:] = ascending[1:] != ascending[:-1]
    return np.flatnonzero(first), np.cumsum(first) - 1


def _bounds(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Where each of ``parts`` equal ranges of hashes ends among ascending ones."""
    part = ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    return np.searchsorted(part, np.arange(parts, dtype=np.uint64), "right")


# ---------------------------------------------------------------- tokens

def text_tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each token, whether it has a letter or digit; tokens and half of each text)."""
    data, offsets = text_buffer(pc.utf8_lower(column))
    starts, ends, counts = token_spans(data, offsets)
    w = hash_spans(data, starts, ends)
    letter = ((data >= 97) & (data <= 122)) | ((data >= 48) & (data <= 57)) | (data >= 0x80)
    sums = np.zeros(len(data) + 1, np.int32)
    np.cumsum(letter, out=sums[1:])
    half = np.zeros(len(counts), np.int64)
    window, per = shingles(w, counts, 5)
    held = np.flatnonzero(per)
    if len(held):
        least = np.minimum.reduceat(window, (np.cumsum(per) - per)[held])
        half[held] = mix(least).astype(np.int64) & 1
    return w, sums[ends] > sums[starts], counts, half


class Book:
    """Numbers of frequent words, and over how many buckets a word's trigrams are dealt."""

    def __init__(self, words: np.ndarray, split: np.ndarray):
        slot = np.full(SLOTS, -1, np.int32)
        at = (words & np.uint64(SLOTS - 1)).astype(np.int64)
        slot[at[::-1]] = np.arange(len(words))[::-1]
        # of words that share a slot, the most frequent stays
        keep = slot[at] == np.arange(len(words))
        self.words, self.split = words[keep], split[keep]
        slot[slot >= 0] = (np.cumsum(keep) - 1)[slot[slot >= 0]]
        self.slot = slot
        self.size = len(self.words)

    def __getstate__(self):
        return self.words, self.split

    def __setstate__(self, state):
        self.__init__(*state)

    def codes(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of each word; hashes of those without one, in order).  ``size`` is the border, ``size + 1`` a word without number."""
        code = self.slot[w & np.uint64(SLOTS - 1)]
        known = code >= 0
        if self.size:
            known &= self.words[code] == w
        return np.where(known, code, self.size + 1).astype(np.uint32), w[~known]


def code_book(texts: DataFrame, bucket: int) -> Book:
    """The words that repeat within batches of texts, the most frequent first; one of more than ``bucket`` tokens is dealt."""

    def run(source):
        for batch in batches(source):
            data, offsets = text_buffer(pc.utf8_lower(batch.column(0)))
            starts, ends, _ = token_spans(data, offsets)
            w, times = np.unique(hash_spans(data, starts, ends), return_counts=True)
            w, times = w[times > 1], times[times > 1]
            yield pa.RecordBatch.from_pydict({"w": pa.array(w.view(np.int64)), "times": pa.array(times.astype(np.int64))})

    spark = texts.sparkSession
    counted, path = handed(texts.select("text").mapInArrow(run, "w long, times long").groupBy("w").agg(
        F.sum("times").alias("times")), "op6-frequent")
    # the least number of times that fits the book, found without a sort; of the words of that number a part, by their hash
    with cleaned(spark):
        found = counted.groupBy(F.least("times", F.lit(1 << 16)).alias("times")).count().orderBy(F.desc("times")).collect()
    room, least, part = BOOK, 0, 0
    for times, words in found:
        least, part = times, min(1024, 1024 * room // words)
        room -= words
        if room <= 0:
            break
    top = counted.where((F.col("times") > least) | ((F.col("times") == least) & (F.pmod(F.col("w"), F.lit(1024)) < part))).toArrow()
    drop_written(spark, path)
    w, times = top["w"].to_numpy().view(np.uint64), top["times"].to_numpy()
    order = np.lexsort((w, -times))
    return Book(w[order], -(-times[order] // bucket))


def tokens(texts: DataFrame, book, passage: int, chunk: int) -> DataFrame:
    """chunk, n, head (key, m, tokens, half and passages of its texts, scored tokens of those) and body (numbers, hashes, scored)."""

    def run(source):
        held, size, made = [], 0, TaskContext.get().partitionId() << 32

        def row():
            keys, m, w, scored, counts, half = (np.concatenate(x) for x in zip(*held))
            codes, rare = book.value.codes(w)
            at, passages = passage_places(counts, passage)
            of = np.bincount(at[scored], minlength=int(passages.sum())).astype(np.uint32)
            head = packed(keys, m, counts.astype(np.uint32), half.astype(np.uint8), passages.astype(np.uint32), of)
            return pa.RecordBatch.from_pydict({
                "chunk": pa.array([made], pa.int64()), "n": pa.array([len(w)], pa.int64()),
                "head": pa.array([head], pa.binary()),
                "body": pa.array([packed(codes, rare, np.packbits(scored))], pa.binary())})

        for batch in batches(source):
            w, scored, counts, half = text_tokens(batch.column(2))
            some = counts > 0
            held.append((batch.column(0).to_numpy()[some], batch.column(1).to_numpy()[some], w, scored, counts[some], half[some]))
            size += len(w)
            if size >= chunk:
                yield row()
                held, size, made = [], 0, made + 1
        if size:
            yield row()

    return texts.select("key", "m", "text").mapInArrow(run, "chunk long, n long, head binary, body binary")


def passage_places(counts: np.ndarray, passage: int) -> tuple[np.ndarray, np.ndarray]:
    """(passage of each token, counted through all texts; passages of each text)."""
    passages = np.maximum(counts // passage, 1)
    text = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    return (np.cumsum(passages) - passages)[text] + np.minimum(place // passage, passages[text] - 1), passages


def deal(held: DataFrame, book, buckets: int, rounds: int, r: int, passage: int | None) -> DataFrame:
    """The trigrams of round ``r`` as messages to their buckets, with their passages if ``passage`` is given."""

    def run(source):
        b = book.value
        K, split, home = b.size, b.split, (b.words % np.uint64(buckets)).astype(np.int64)
        dealt = np.flatnonzero(split > 1)
        border = int(BORDER) % buckets
        asked = home % rounds == r
        asked[dealt] = True
        for batch in batches(source):
            for chunk, head, body in zip(*(batch.column(i).to_pylist() for i in range(3))):
                _, m, counts, half, passages, _ = unpacked(head)
                code, rare, bits = unpacked(body)
                counts = counts.astype(np.int64)
                start = np.cumsum(counts) - counts
                word = code.astype(np.intp)
                word[code == K + 1] = np.arange(K + 1, K + 1 + len(rare))
                rare_home = (rare % np.uint64(buckets)).astype(np.int64)
                # tokens whose middle word, the one before them, is of this round; a text's first has the border
                mine = np.concatenate([[False], np.concatenate([asked, [False], rare_home % rounds == r])[word[:-1]]])
                mine[start] = border % rounds == r
                mine = np.flatnonzero(mine)
                text = np.repeat(np.arange(len(counts)), counts)[mine]
                place = mine - start[text]
                v = np.where(place > 0, word[mine - 1], K)
                to = np.concatenate([home, [border], rare_home])[v]
                if len(dealt):
                    ways = np.ones(K + 1 + len(rare), np.int64)
                    ways[dealt] = np.minimum(split[dealt], buckets)
                    hot = np.flatnonzero(ways[v] > 1)
                    u = np.concatenate([b.words, [BORDER], rare])[np.where(place[hot] > 1, word[mine[hot] - 2], K)]
                    to[hot] = (to[hot] + (mix(u) % ways[v[hot]].astype(np.uint64)).astype(np.int64)) % buckets
                    here = np.flatnonzero(to % rounds == r)
                    mine, text, place, v, to = (x[here] for x in (mine, text, place, v, to))
                if not len(mine):
                    continue
                to //= rounds
                order = np.argsort(to.astype(np.uint16) if buckets // rounds < 65536 else to, kind="stable")
                mine, text, place, v, to = (x[order] for x in (mine, text, place, v, to))
                three = [np.where(place > 1, word[mine - 2], K), v, word[mine]]
                ms, mi = np.unique(m, return_inverse=True)
                mi, of = mi.astype(np.uint32)[text], half[text]
                if passage is not None:
                    ends = np.cumsum(passages.astype(np.int64)) - 1
                    places = np.minimum((ends + 1 - passages)[text] + place // passage, ends[text]).astype(np.uint32)
                    scored = np.unpackbits(bits, count=len(word))[mine]
                out = []
                cuts, _ = _runs(to)
                for i, j in zip(cuts, [*cuts[1:], len(to)]):
                    whole = [x[i:j] for x in three]
                    hashes = np.concatenate([rare[x[x > K] - (K + 1)] for x in whole])
                    arrays = [ms, mi[i:j], of[i:j], *(np.minimum(x, K + 1).astype(np.uint32) for x in whole), hashes]
                    if passage is not None:
                        arrays += [steps(places[i:j]), np.packbits(scored[i:j])]
                    out.append((int(to[i]) * rounds + r, packed(*arrays)))
                yield pa.RecordBatch.from_pydict({
                    "kind": pa.array([TOKENS] * len(out), pa.int32()), "at": pa.array([x for x, _ in out], pa.int64()),
                    "src": pa.array([chunk] * len(out), pa.int64()), "blob": pa.array([x for _, x in out], pa.binary()),
                    "s": pa.nulls(len(out), pa.list_(pa.float64()))})

    return held.select("chunk", "head", "body").mapInArrow(run, MESSAGE)


# ---------------------------------------------------------------- buckets

def messages(rows: list[tuple]) -> pa.Table:
    kind, at, src, blob, s = zip(*rows) if rows else ([],) * 5
    return pa.table({"kind": pa.array(kind, pa.int32()), "at": pa.array(at, pa.int64()), "src": pa.array(src, pa.int64()),
                     "blob": pa.array(blob, pa.binary()), "s": pa.array(s, pa.list_(pa.float64()))})


def of_kind(table: pa.Table, kind: int) -> list[tuple[int, bytes]]:
    """(src, blob) of the messages of a kind, by src."""
    mine = table.filter(pc.equal(table["kind"], kind)).select(["src", "blob"]).sort_by("src")
    return list(zip(mine["src"].to_pylist(), mine["blob"].to_pylist()))


def _dense(x: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(rank of each value among the distinct ones, those)."""
    there = np.zeros(size, bool)
    there[x] = True
    return (np.cumsum(there) - 1)[x], np.flatnonzero(there)


def _counts_of_counts(n: np.ndarray, m: np.ndarray, size: int) -> np.ndarray:
    """Of each model, in either half: how many of ``n`` (2 x things) are 1, 2, 3 and 4."""
    return np.stack([np.bincount(m[n[x] == j], minlength=size) for x in (0, 1) for j in (1, 2, 3, 4)], 1).astype(float)


def _context(n: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """2 x (total, things counted once, twice and more often) x contexts, of things in runs of one context."""
    return np.stack([[np.add.reduceat(f.astype(np.int64), starts) for f in (c, c == 1, c == 2, c >= 3)] for c in n]).astype(float)


class Bucket:
    """The distinct trigrams, pairs and words of a bucket and their counts; of a dealt word's pairs a part of the counts.

    With ``places``, also the trigram of each token.
    """

    def __init__(self, parts: list[list[np.ndarray]], book: Book, places: bool):
        K = book.size
        sizes = [len(p[1]) for p in parts]
        self.cuts = np.concatenate([[0], np.cumsum(sizes)])
        rare, number = np.unique(np.concatenate([p[6] for p in parts]), return_inverse=True)
        three, at = np.empty((3, int(self.cuts[-1])), np.int64), 0
        for p, i, j in zip(parts, self.cuts, self.cuts[1:]):
            for k in range(3):
                x = p[3 + k].astype(np.int64)
                unknown = np.flatnonzero(x == K + 1)
                x[unknown] = K + 1 + number[at:at + len(unknown)]
                at += len(unknown)
                three[k, i:j] = x
        hashes = np.concatenate([book.words, [BORDER], rare])
        self.ms = np.unique(np.concatenate([p[0] for p in parts]))
        m = np.concatenate([np.searchsorted(self.ms, p[0])[p[1]] for p in parts])
        self.half = np.concatenate([p[2] for p in parts]) == 1
        (u, us), (v, vs), (w, ws) = (_dense(x, len(hashes)) for x in three)
        del three
        ub, vb, wb = (int(len(x)).bit_length() for x in (us, vs, ws))
        context = (m << vb | v) << ub | u
        known = None
        if len(self.ms).bit_length() + vb + ub + wb > 61:
            known, context = np.unique(context, return_inverse=True)
        context <<= wb
        context |= w
        del u, v, w, m
        if places:
            grams, self.gram = np.unique(context, return_inverse=True)
            n, n1 = np.bincount(self.gram, minlength=len(grams)), np.bincount(self.gram[self.half], minlength=len(grams))
        else:
            context <<= 1
            context |= self.half
            context.sort()
            starts, _ = _runs(context >> 1)
            grams, n, n1 = context[starts] >> 1, np.diff(np.append(starts, len(context))), np.add.reduceat(context & 1, starts)
        del context
        self.n = np.stack([n - n1, n1])
        w, context = grams & ((1 << wb) - 1), grams >> wb
        self.context_starts, self.context = _runs(context)
        mv = (context if known is None else known[context]) >> ub
        self.gram_m = mv >> vb
        pairs, self.pair = np.unique(mv << wb | w, return_inverse=True)
        self.pair_n = np.stack([np.bincount(self.pair[n > 0], minlength=len(pairs)) for n in self.n])
        w, mv = pairs & ((1 << wb) - 1), pairs >> wb
        self.v_starts, self.v = _runs(mv)
        at = vs[mv & ((1 << vb) - 1)]
        self.pair_m, self.pair_v = mv >> vb, hashes[at]
        split = np.concatenate([book.split, np.ones(len(hashes) - K, np.int64)])
        self.dealt = split[at] > 1
        words, self.word = np.unique(self.pair_m << wb | w, return_inverse=True)
        self.word_m = words >> wb
        name = mix(hashes[ws[words & ((1 << wb) - 1)]] + self.ms.astype(np.uint64)[self.word_m] * _ODD)
        self.word_order = np.argsort(name)
        self.word_name = name[self.word_order]
        own = np.where(self.dealt, 0, self.pair_n > 0)
        self.word_n = np.stack([np.bincount(self.word, x, len(words)).astype(np.uint32) for x in own])
        # a dealt word's pairs by the names of their last words
        k = np.flatnonzero(self.dealt)
        name = name[self.word[k]]
        order = np.lexsort((self.pair_v[k], name))
        self.dealt_pairs, self.dealt_name = k[order], name[order]


def first(held: DataFrame, book, word_parts: int, pair_parts: int) -> DataFrame:
    """What each bucket asks for, and its counts of counts."""

    def run(table: pa.Table) -> pa.Table:
        found = of_kind(table, TOKENS)
        b = Bucket([unpacked(blob) for _, blob in found], book.value, False)
        at = table["at"][0].as_py()
        rows, i = [], 0
        order, size = b.word_order, len(b.ms)
        n, m = b.word_n[:, order], b.word_m[order].astype(np.uint32)
        for part, j in enumerate(_bounds(b.word_name, word_parts).tolist()):
            if j > i:
                rows.append((WORD_ASK, part, at, packed(steps(b.word_name[i:j]), n[0, i:j], n[1, i:j], m[i:j], b.ms), None))
            i = j
        k, i = b.dealt_pairs, 0
        for part, j in enumerate(_bounds(b.dealt_name, pair_parts).tolist()):
            if j > i:
                c = k[i:j]
                vs, v = np.unique(b.pair_v[c], return_inverse=True)
                rows.append((PAIR_ASK, part, at, packed(
                    steps(b.dealt_name[i:j]), *b.pair_n[:, c].astype(np.uint32), b.pair_m[c].astype(np.uint32), b.ms,
                    v.astype(np.uint32), vs), None))
            i = j
        own = ~b.dealt
        stats = np.hstack([_counts_of_counts(b.n, b.gram_m, size), _counts_of_counts(b.pair_n[:, own], b.pair_m[own], size)])
        rows += [(STATS, m, None, None, s) for m, s in zip(b.ms.tolist(), stats.tolist())]
        return messages(rows)

    return held.groupBy("at").applyInArrow(run, MESSAGE)


def _summed(found: list[tuple[int, bytes]]):
    """(parts, the thing of each entry, both sums, models, model of each thing, its first entry); things are words, or pairs."""
    parts = [unpacked(blob) for _, blob in found]
    names = [np.cumsum(p[0]) if len(p) < 7 else mix(np.cumsum(p[0]) + p[6][p[5]] * _ODD) for p in parts]
    names, at, to = np.unique(np.concatenate(names), return_index=True, return_inverse=True)
    n = np.stack([np.bincount(to, np.concatenate([p[1 + x] for p in parts]), len(names)).astype(np.int64) for x in (0, 1)])
    ms = np.unique(np.concatenate([p[4] for p in parts]))
    m = np.concatenate([np.searchsorted(ms, p[4])[p[3]] for p in parts])[at]
    return parts, to, n, ms, m, at


def _replies(kind: int, part: int, found, parts, to: np.ndarray, n: np.ndarray) -> list[tuple]:
    rows, i = [], 0
    for (src, _), p in zip(found, parts):
        j = i + len(p[0])
        if src >= 0:
            rows.append((kind, src, part, packed(*n[:, to[i:j]].astype(np.uint32)), None))
        i = j
    return rows


def sum_pairs(asked: DataFrame, word_parts: int) -> DataFrame:
    """Replies on dealt words' pairs, what these add to words, counts of counts, and these middle words' figures."""

    def run(table: pa.Table) -> pa.Table:
        found, part = of_kind(table, PAIR_ASK), table["at"][0].as_py()
        parts, to, n, ms, m, at = _summed(found)
        rows = _replies(PAIR_REPLY, part, found, parts, to, n)
        rows += [(STATS, x, None, None, s) for x, s in zip(ms.tolist(), np.hstack([
            np.zeros((len(ms), 8)), _counts_of_counts(n, m, len(ms))]).tolist())]
        v = np.concatenate([p[6][p[5]] for p in parts])[at]
        order = np.lexsort((v, m))
        starts, _ = _runs(m[order].astype(np.uint64) * _ODD + v[order])
        figures = _context(n[:, order], starts).transpose(2, 0, 1).reshape(len(starts), 8)
        rows += [(HOT_STATS, x, y, None, s) for x, y, s in zip(
            ms[m[order][starts]].tolist(), v[order][starts].view(np.int64).tolist(), figures.tolist())]
        words, at, to = np.unique(np.concatenate([np.cumsum(p[0]) for p in parts])[at], return_index=True, return_inverse=True)
        add = [np.bincount(to, n[x] > 0, len(words)).astype(np.uint32) for x in (0, 1)]
        i = 0
        for k, j in enumerate(_bounds(words, word_parts).tolist()):
            if j > i:
                rows.append((WORD_ASK, k, -1, packed(steps(words[i:j]), *(x[i:j] for x in add), m[at[i:j]].astype(np.uint32), ms), None))
            i = j
        return messages(rows)

    return asked.groupBy("at").applyInArrow(run, MESSAGE)


def sum_words(asked: DataFrame) -> DataFrame:
    """Replies on words, and by model their counts of counts and figures."""

    def run(table: pa.Table) -> pa.Table:
        found, part = of_kind(table, WORD_ASK), table["at"][0].as_py()
        parts, to, n, ms, m, _ = _summed(found)
        rows = _replies(WORD_REPLY, part, found, parts, to, n)
        of = [np.bincount(m, f, len(ms)) for c in n for f in (c, c == 1, c == 2, c >= 3, c > 0)]
        stats = np.hstack([_counts_of_counts(n, m, len(ms)), np.stack(of, 1)])
        rows += [(WORD_STATS, x, None, None, s) for x, s in zip(ms.tolist(), stats.tolist())]
        return messages(rows)

    return asked.groupBy("at").applyInArrow(run, MESSAGE)


# ---------------------------------------------------------------- probabilities

def discounts(counts: np.ndarray) -> np.ndarray:
    """Three discounts (and none, for what is not counted) of counts of counts (models x 4)."""
    n1, n2, n3, n4 = counts.T
    with np.errstate(divide="ignore", invalid="ignore"):
        y = np.where((n1 > 0) & (n2 > 0), n1 / (n1 + 2 * n2), 0.5)
        out = [np.zeros(len(n1))]
        for value, of, other, cap in ((1 - 2 * y * n2 / n1, n1, 0.5, 0.95), (2 - 3 * y * n3 / n2, n2, 1.0, 1.95),
                                      (3 - 4 * y * n4 / n3, n3, 1.5, 2.95)):
            out.append(np.maximum(0.05, np.minimum(cap, np.where(of > 0, value, other))))
    return np.stack(out)


def interpolated(n: np.ndarray, context: np.ndarray, at: np.ndarray, d: np.ndarray, m: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Probabilities from counts, the figures of contexts (``at`` each count's), their models' discounts and lower order."""
    t, a, b, c = context
    of = np.zeros(len(t), np.int64)
    of[at] = m
    gamma = d[1, of] * a
    gamma += d[2, of] * b
    gamma += d[3, of] * c
    gamma /= np.maximum(t, 1)
    cut = d.take(np.minimum(n, 3) * d.shape[1] + m)
    total = t[at]
    return np.where(total > 0, (n - cut) / np.maximum(total, 1) + gamma[at] * lower, lower)


def second(held: DataFrame, book, stats: dict, hot: dict, words: dict) -> DataFrame:
    """chunk and sums: passages of each chunk, and the sums of their tokens' logarithms of both probabilities."""

    def run(table: pa.Table) -> pa.Table:
        found = of_kind(table, TOKENS)
        parts = [unpacked(blob) for _, blob in found]
        b = Bucket(parts, book.value, True)
        counts, figures = np.array([stats[m] for m in b.ms.tolist()]), np.array([words[m] for m in b.ms.tolist()])
        of_word = np.empty((2, len(b.word_m)), np.int64)
        of_word[:, b.word_order] = np.hstack([np.stack(unpacked(blob)) for _, blob in of_kind(table, WORD_REPLY)])
        pair_n, v_figures = b.pair_n, _context(b.pair_n, b.v_starts)
        if len(b.dealt_pairs):
            pair_n[:, b.dealt_pairs] = np.hstack([np.stack(unpacked(blob)) for _, blob in of_kind(table, PAIR_REPLY)])
            for k in np.unique(b.v[b.dealt_pairs]).tolist():
                i = b.v_starts[k]
                v_figures[:, :, k] = np.reshape(hot[int(b.ms[b.pair_m[i]]), int(b.pair_v[i].view(np.int64))], (2, 4))
        contexts = _context(b.n, b.context_starts)
        p, o = [], []
        for x in (0, 1):
            one = figures[:, 8 + 5 * x:13 + 5 * x]
            d = discounts(figures[:, 4 * x:4 * x + 4])
            m = b.word_m
            alone = interpolated(of_word[x], one[:, :4].T, m, d, m, (1 / (one[:, 4] + 1))[m])
            two = interpolated(pair_n[x], v_figures[x], b.v, discounts(counts[:, 8 + 4 * x:12 + 4 * x]), b.pair_m, alone[b.word])
            # only trigrams of the other half's texts are asked for
            asked = np.flatnonzero(b.n[1 - x])
            p.append(np.empty(len(b.gram_m)))
            p[x][asked] = interpolated(b.n[x][asked], contexts[x], b.context[asked], discounts(counts[:, 4 * x:4 * x + 4]),
                                       b.gram_m[asked], two[b.pair[asked]])
            o.append(alone)
        # a text of half 1 is scored by the counts of half 0
        word = b.word[b.pair]
        rows = []
        for (chunk, _), part, i, j in zip(found, parts, b.cuts, b.cuts[1:]):
            scored = np.flatnonzero(np.unpackbits(part[8], count=j - i))
            if not len(scored):
                continue
            g, half = b.gram[i:j][scored], b.half[i:j][scored]
            place = np.cumsum(part[7], dtype=np.int64)[scored]
            starts, _ = _runs(place)
            sums = []
            for of, at in ((p, g), (o, word[g])):
                logs = np.log(np.where(half, of[0][at], of[1][at])).astype(np.float32).astype(np.float64)
                sums.append(np.add.reduceat(logs, starts))
            rows.append((chunk, packed(steps(place[starts].astype(np.uint32)), *sums)))
        return pa.table({"chunk": pa.array([c for c, _ in rows], pa.int64()), "sums": pa.array([s for _, s in rows], pa.binary())})

    return held.groupBy("at").applyInArrow(run, "chunk long, sums binary")


def add_up(sums: DataFrame) -> DataFrame:
    """One row of sums for each chunk."""

    def run(table: pa.Table) -> pa.Table:
        places, x, y = (np.concatenate(a) for a in zip(*((np.cumsum(p[0], dtype=np.int64), *p[1:]) for p in (
            unpacked(blob) for blob in table["sums"].to_pylist()))))
        size = int(places.max()) + 1
        there = np.flatnonzero(np.bincount(places, minlength=size))
        return pa.table({"chunk": table["chunk"].slice(0, 1), "sums": pa.array([packed(
            steps(there.astype(np.uint32)), *(np.bincount(places, s, size)[there] for s in (x, y)))], pa.binary())})

    return sums.groupBy("chunk").applyInArrow(run, "chunk long, sums binary")


def verdicts(held: DataFrame, sums: DataFrame, share: float) -> DataFrame:
    """key, m, hard and easy of each text with scored tokens."""

    def run(source):
        for batch in batches(source):
            for head, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys, m, _, _, passages, of = unpacked(head)
                place, *both = unpacked(blob)
                place = np.cumsum(place, dtype=np.int64)
                text = np.repeat(np.arange(len(keys)), passages)[place]
                starts, _ = _runs(text)
                last = np.diff([*starts, len(text)]) - 1
                pick = []
                for s, at in zip(both, (np.floor(last * (1 - share)), np.ceil(last * share))):
                    mean = -(s / of[place])
                    pick.append(mean[np.lexsort((mean, text))][starts + at.astype(np.int64)])
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array(keys[text[starts]]), "m": pa.array(m[text[starts]]), "hard": pa.array(pick[0]), "easy": pa.array(pick[1])})

    return held.join(sums, "chunk").select("head", "sums").mapInArrow(run, "key long, m long, hard double, easy double")


# ---------------------------------------------------------------- the whole

def _by(rows: DataFrame, *by: str, size: int) -> list:
    """Sums of the figures of messages."""
    with cleaned(rows.sparkSession):
        return rows.groupBy(*by).agg(F.array(*[F.sum(F.col("s")[i]) for i in range(size)]).alias("s")).collect()


def score(texts: DataFrame, passage: int, share: float, chunk: int = CHUNK, bucket: int = BUCKET,
          least: int = ROUND) -> tuple[DataFrame, list[str]]:
    """(key, m, hard and easy of texts (key, m, text) under model m of the other half; folders that it reads)."""
    spark: SparkSession = texts.sparkSession
    book = spark.sparkContext.broadcast(code_book(texts, bucket))
    held, held_path = handed(tokens(texts, book, passage, chunk), "op6-tokens")
    size = held.agg(F.sum("n")).first()[0] or 0
    rounds = min(ROUNDS, -(-size // least)) or 1
    buckets = rounds * max(8, -(-size // (rounds * bucket)))
    parts = rounds * max(8, -(-size // (4 * rounds * bucket)))
    hot = bool((book.value.split > 1).any())

    def union(tables: list[DataFrame]) -> DataFrame:
        return spark.read.schema(MESSAGE).parquet(*tables)

    asked = [handed(first(deal(held, book, buckets, rounds, r, None), book, parts, parts), "op6-asked")[1] for r in range(rounds)]
    pairs, replied = [], []
    for r in range(rounds) if hot else ():
        mine = (F.col("kind") == PAIR_ASK) & (F.col("at") % rounds == r)
        pairs.append(handed(sum_pairs(union(asked).where(mine), parts), "op6-pairs")[1])
    for r in range(rounds):
        mine = (F.col("kind") == WORD_ASK) & (F.col("at") % rounds == r)
        replied.append(handed(sum_words(union(asked + pairs).where(mine)), "op6-words")[1])
    told, replies = union(asked + pairs), union(replied + pairs)
    stats = {r["at"]: r["s"] for r in _by(told.where(F.col("kind") == STATS), "at", size=16)}
    dealt = {(r["at"], r["src"]): r["s"] for r in _by(told.where(F.col("kind") == HOT_STATS), "at", "src", size=8)} if hot else {}
    words = {r["at"]: r["s"] for r in _by(replies.where(F.col("kind") == WORD_STATS), "at", size=18)}
    drop_written(spark, *asked)
    replies = replies.where(F.col("kind").isin(WORD_REPLY, PAIR_REPLY))
    sums, before = None, None
    for r in range(rounds):
        rows = deal(held, book, buckets, rounds, r, passage).unionByName(replies.where(F.col("at") % rounds == r))
        more = second(rows, book, stats, dealt, words)
        sums, now = handed(add_up(more.unionByName(sums) if sums else more), "op6-sums")
        if before:
            drop_written(spark, before)
        before = now
    drop_written(spark, *pairs, *replied)
    return verdicts(held, sums, share), [held_path, before]
