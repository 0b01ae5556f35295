"""Toxicity: maximum-scoring segments of token log-odds, aggregated by extreme-value calibration.

Tokens of a word are the word itself and its prefixes of 4 to 6 bytes (in
lower case, outer ASCII punctuation removed), hashed into a table of
``BUCKETS`` entries, which bounds the model whatever the vocabulary.

1. Count, over the labelled training documents, in how many toxic and how many
   clean documents each token occurs (equal texts count once).  A token's
   weight is its log-odds ratio under an informative Dirichlet prior
   that grows with the token's overall frequency, less its standard error.
   A word takes the weight of its strongest token; words without evidence
   take a small penalty, so that a random passage scores below zero.
2. All maximal scoring segments of a text (the segments of the linear-time
   all-maximal-scoring-subsequences scan) are found; the penalty between
   positive words comes from prefix sums, so the scan visits positive words only.
3. Segment scores of clean training texts follow an extreme-value law with
   parameters fitted to their best segments; it turns a segment's score and the
   text's length into an expected number of chance segments, and a document's
   evidence is the sum of -log of it over its significant segments.
4. The evidence is mapped to a probability by a logistic curve.  Curve and
   extreme-value law are fitted crosswise: the training rows form two folds,
   and each fold is scored by the counts of the other.

Labels of held-out rows (crc32 of the id as text, mod 3, is 1) are read by no
step.  Labels, language, source and id are no input of a score.

Edge cases: null and empty texts have no segment and get the score of no
evidence; a null doc_id counts as held out; a null label is no label; rows that
repeat a doc_id are each scored; without labelled rows of both kinds every
score is 0; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, hash_spans, lower_ascii, need, prepare, text_buffer, word_spans, written

BUCKETS = 1 << 20
PREFIXES = (4, 5, 6)
#: Weight of the Dirichlet prior, in tokens of each class.
PRIOR = 50.0
#: Least prior count of a token in each class.
FLOOR = 0.5
#: Standard errors taken off a log-odds ratio.
ERRORS = 2.33
#: Score of a word without evidence.
PENALTY = 0.05
#: Log-odds above which a word can be part of a toxic passage.
LEAST = 0.5
#: Chance segments per text below which a segment is significant.
SIGNIFICANT = 0.05
CUT = 0.7

_OUTER = np.zeros(256, bool)
_OUTER[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def word_tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of each word's tokens: words x tokens, words per text)."""
    data, offsets = text_buffer(column)
    data = lower_ascii(data)
    starts, ends, counts = word_spans(data, offsets)
    if not len(starts):
        return np.zeros((0, len(PREFIXES) + 1), np.int64), counts
    starts, ends = starts.copy(), ends.copy()
    for _ in range(3):  # up to three marks on either side
        inner = ends - starts > 1
        starts += inner & _OUTER[data[starts]]
        inner = ends - starts > 1
        ends -= inner & _OUTER[data[ends - 1]]
    tokens = [hash_spans(data, starts, ends)]
    for n in PREFIXES:
        tokens.append(hash_spans(data, starts, np.minimum(ends, starts + n)) + np.uint64(n))
    return (np.stack(tokens, 1) % np.uint64(BUCKETS)).astype(np.int64), counts


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, toxic and fold (0 or 2) of the labelled rows that are not held out; equal texts once.

    Which row stands for equal texts is settled by ids and hashes; then each
    text moves once, in the same way at every size.
    """
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    marked = need(labels, "doc_id", "toxic").where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold != 1))
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = need(docs, "doc_id", "text").where(F.col("doc_id").isNotNull() & (fold != 1)).select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.xxhash64("text"))
    chosen = rows.select("doc_id", "key").join(marked, "doc_id").groupBy("key").agg(
        F.min("doc_id").alias("doc_id"), F.max("toxic").cast("int").alias("toxic"), F.min(fold).cast("int").alias("fold"))
    texts = rows.groupBy("doc_id", "key").agg(F.first("text").alias("text"))
    return texts.join(chosen.hint("merge"), ["doc_id", "key"]).select("text", "toxic", "fold")


def count_tokens(rows: DataFrame) -> np.ndarray:
    """Documents per fold (2), class (2) and bucket, counted in tasks and summed by Spark."""

    def run(source):
        held = {}
        for batch in batches(source):
            tokens, counts = word_tokens(batch.column(0))
            kind = batch.column(1).to_numpy() + batch.column(2).to_numpy()  # fold 0 or 2 plus label
            doc = np.repeat(np.arange(len(counts)), counts)
            seen = np.unique((doc[:, None] * BUCKETS + tokens).ravel())
            which, bucket = kind[seen // BUCKETS], seen % BUCKETS
            for k in range(4):
                held[k] = held.get(k, 0) + np.bincount(bucket[which == k], minlength=BUCKETS)
        for k, n in held.items():
            used = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({
                "kind": pa.array(np.full(len(used), k, np.int32)), "bucket": pa.array(used.astype(np.int32)),
                "n": pa.array(n[used].astype(np.int64))})

    counted = rows.mapInArrow(run, "kind int, bucket int, n long").groupBy("kind", "bucket").agg(F.sum("n").alias("n"))
    out = np.zeros((2, 2, BUCKETS))
    table = counted.toArrow()  # at most 4 * BUCKETS rows
    if table.num_rows:
        kind = table.column("kind").to_numpy()
        out[kind // 2, kind % 2, table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    return out


def weights(counts: np.ndarray) -> np.ndarray:
    """Per bucket: log-odds ratio of toxic against clean under the prior, less its standard error."""
    clean, toxic = counts
    all_ = clean + toxic
    total = all_.sum()
    if not toxic.sum() or not clean.sum():
        return np.zeros(BUCKETS, np.float32)
    prior = FLOOR + PRIOR * all_ / total
    a, b = toxic + prior, clean + prior
    odds = np.log(a / (toxic.sum() + PRIOR - a)) - np.log(b / (clean.sum() + PRIOR - b))
    return (odds - ERRORS * np.sqrt(1 / a + 1 / b)).astype(np.float32)


def maximal_segments(at: np.ndarray, value: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first word, last word, score), in linear time.

    ``at`` are the places of the positive words and ``value`` their scores;
    every other word scores ``-PENALTY``.  One pass with a list of candidate
    segments, each with the running totals before (l) and after (r) it and a
    link to the nearest candidate to its left whose l is lower.  A search goes
    along these links, so a candidate is stepped over once; each is joined once.
    """
    segments: list[tuple[int, int, float, float, int]] = []  # first, last, l, r, link
    running, last = 0.0, -1
    for i, s in zip(at.tolist(), value.tolist()):
        running -= PENALTY * (i - last - 1)
        last = i
        first, low = i, running
        running += s
        j = len(segments) - 1
        while True:
            while j >= 0 and segments[j][2] >= low:
                j = segments[j][4]
            if j < 0 or segments[j][3] >= running:
                segments.append((first, i, low, running, j))
                break
            first, _, low, _, link = segments[j]
            del segments[j:]
            j = link
    return [(a, b, r - l) for a, b, l, r, _ in segments]


def scan(column: pa.Array, weight: np.ndarray) -> tuple[list[list[tuple[int, int, float]]], np.ndarray]:
    """(maximal segments of each text, words of each text)."""
    tokens, counts = word_tokens(column)
    best = weight[tokens].max(1) if len(tokens) else np.zeros(0, np.float32)
    good = np.flatnonzero(best > LEAST)
    first = np.concatenate([[0], np.cumsum(counts)])
    cut = np.searchsorted(good, first)
    return [maximal_segments(good[a:b] - f, best[good[a:b]]) if b > a else []
            for a, b, f in zip(cut, cut[1:], first)], counts


class Calibration:
    """Extreme-value law of chance segments and the logistic curve of the evidence."""

    def __init__(self, scale: float, level: float, slope: float, shift: float):
        self.scale, self.level, self.slope, self.shift = scale, level, slope, shift

    def evidence(self, segments: list[tuple[int, int, float]], words: int) -> float:
        """Sum of -log expected chance segments over the significant ones, on a log scale."""
        total = 0.0
        for _, _, score in segments:
            expected = -self.scale * (score - self.level) + np.log(max(words, 1))
            if expected < np.log(SIGNIFICANT):
                total -= expected
        return float(np.log1p(total))

    def score(self, evidence: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * evidence + self.shift, -50, 50))))


#: Upper edges of the histogram that carries best-segment scores to the fit.
_GRID = np.arange(0, 12, 0.05)


def fit(rows: DataFrame, counts: np.ndarray) -> Calibration:
    """Fit both steps on crosswise scores; only fixed-size histograms reach the driver."""
    spark = rows.sparkSession
    models = [weights(counts[1]), weights(counts[0])]  # by fold: the other fold's
    shared = spark.sparkContext.broadcast(models)

    def best(source):
        for batch in batches(source):
            toxic, fold = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for f in (0, 2):
                own = np.flatnonzero(fold == f)
                segments, words = scan(batch.column(0).take(pa.array(own)), shared.value[f // 2])
                top = np.array([max([s for _, _, s in x], default=0.0) for x in segments])
                yield pa.RecordBatch.from_pydict({
                    "toxic": pa.array(toxic[own].astype(np.int32)), "segments": pa.array(
                        [[s for _, _, s in x] for x in segments], pa.list_(pa.float64())),
                    "best": pa.array(top), "words": pa.array(words.astype(np.int64))})

    scored, _ = written(rows.mapInArrow(best, "toxic int, segments array<double>, best double, words long"), "op8-fit")
    # chance law: P(best > s) ~ words * exp(-scale * (s - level)), from the clean texts' upper tail
    clean = scored.where("toxic = 0 and words > 0")
    bins = clean.groupBy(F.least(F.floor(F.col("best") / 0.05), F.lit(len(_GRID) - 1)).cast("int").alias("bin")).agg(
        F.count("*").alias("n")).collect()
    tail = np.zeros(len(_GRID))
    for r in bins:
        tail[r["bin"]] = r["n"]
    words = clean.agg(F.avg("words")).first()[0] or 1.0
    n = tail.sum()
    above = np.cumsum(tail[::-1])[::-1]
    some = tail[1:].sum()
    if some >= 5:  # exponential tail above LEAST: mean excess gives the scale
        mean = float((tail[1:] * (_GRID[1:] + 0.025)).sum() / some) - LEAST
        scale = 1 / max(mean, 0.05)
        level = LEAST + np.log(max(above[1], 1) / n / words) / scale
    else:
        scale, level = 2.0, LEAST + np.log(1 / (n + 1) / words) / 2.0
    law = Calibration(scale, level, 1.0, 0.0)

    def graded(source):
        for batch in batches(source):
            ev = [law.evidence([(0, 0, s) for s in x], w) for x, w in zip(
                batch.column("segments").to_pylist(), batch.column("words").to_pylist())]
            yield pa.RecordBatch.from_pydict({"toxic": batch.column("toxic"), "bin": pa.array(
                np.round(np.array(ev) * 20).astype(np.int32))})

    table = scored.mapInArrow(graded, "toxic int, bin int").groupBy("toxic", "bin").agg(F.count("*").alias("n")).collect()
    x = np.array([r["bin"] / 20 for r in table])
    y = np.array([float(r["toxic"]) for r in table])
    m = np.array([float(r["n"]) for r in table])
    if not len(x) or not (y * m).sum() or not ((1 - y) * m).sum():
        return Calibration(scale, level, 0.0, -50.0)
    # logistic regression in one variable by Newton steps with a weak ridge
    a = np.zeros(2)
    design = np.stack([x, np.ones_like(x)], 1)
    for _ in range(60):
        p = 1 / (1 + np.exp(-design @ a))
        slope = design.T @ (m * (y - p)) - 0.05 * a
        curve = (design * (m * p * (1 - p))[:, None]).T @ design + 0.05 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        a = a + step * min(1.0, 2.0 / (np.abs(step).max() + 1e-9))
    return Calibration(scale, level, float(max(a[0], 0.0)), float(a[1]))


def train(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, Calibration]:
    """(weight of each bucket, calibration) from the labelled rows that are not held out."""
    rows, _ = written(training_rows(docs, labels), "op8-training")
    counts = count_tokens(rows)
    return weights(counts.sum(0)), fit(rows, counts)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, and the passages (first word, last word, score) of every document."""
    prepare(docs.sparkSession)
    return score_rows(docs, *train(docs, labels))


def score_rows(docs: DataFrame, weight: np.ndarray, law: Calibration) -> DataFrame:
    """``score_documents`` of any rows, by trained weights; ``doc_id`` may be another key of the row."""
    shared = docs.sparkSession.sparkContext.broadcast(weight)  # BUCKETS floats

    def run(source):
        for batch in batches(source):
            segments, words = scan(batch.column(1), shared.value)
            scores = [law.score(law.evidence(x, n)) for x, n in zip(segments, words.tolist())]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0).cast(pa.int64()), "score": pa.array(scores, pa.float64()),
                "passages": pa.array([[{"first": a, "last": b, "score": s} for a, b, s in x] for x in segments],
                                     pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64())])))})

    out = need(docs, "doc_id", "text").mapInArrow(
        run, "doc_id long, score double, passages array<struct<first:long,last:long,score:double>>")
    return out.select(
        "doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(True)).alias("held_out"),
        "score", (F.col("score") >= CUT).cast("int").alias("predicted"), "passages")
