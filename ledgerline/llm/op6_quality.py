"""Quality rules: counting rules, and word-trigram perplexity under a modified Kneser-Ney model per language.

1. Tokens are words between white space (lower case, marks kept), and single
   characters of scripts written without spaces.  The trigrams of the whole corpus
   count by language; nothing is capped, so what is counted grows with the corpus.
2. Texts are dealt to two halves by their least shingle hash (copies and most
   near copies to the same one), and each half is scored by the counts of the
   other: a text never predicts itself.
3. Per language: modified Kneser-Ney with three discounts per order, and
   continuation counts below the top order, interpolated down to the uniform
   distribution over the words and one unknown word.  ``kneser_ney`` counts and
   scores in packed blocks and rounds, within little disk; ``count_grams`` and
   ``probabilities`` are the plain form of the same model, by which tests hold it.
4. A text's passages of ``PASSAGE`` words get two figures: the log-perplexity per
   word under the model, and the same by word frequencies alone.  Tokens without
   a letter or digit are context only.  The text is rejected if ``SHARE`` of its
   passages lie above the upper end of its language's band by the first figure
   (junk), or ``SHARE`` below the lower end by the second (nothing but frequent
   words); a copy of other text is not rejected for being predicted well.  Either
   end is the median over the language's texts (those that the counting rules
   pass), plus or minus ``BAND`` robust deviations (``percentile_approx``).

A language with fewer than ``LEAST_TEXTS`` passing texts, and rows without a
language, are scored by a model of all languages, under the band of all passing
texts scored by that same model; the number of languages has no limit.

Edge cases: a null or empty text has no words and fails the counting rules;
rows that repeat a doc_id are each judged; a null doc_id is kept as a row; an
empty table gives no row; other columns are ignored; without a ``lang`` column
all texts use the model of all languages.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches, drop_written, hash_spans, mix, prepare, shingles, text_buffer, word_spans, written
from .kneser_ney import BORDER, score, text_tokens

#: Passing texts that give a language a model and a band of its own.
LEAST_TEXTS = 30
PASSAGE = 25
#: Share of a text's passages that decide.
SHARE = 0.5
#: Robust deviations between a language's median log-perplexity and either end of its band.
BAND = 3.0
#: Least deviation, for languages whose texts are nearly all alike.
LEAST_DEVIATION = 0.02
ALL = ""
#: The model of all languages; the others are named by the hash of their language.
MIXED = 0

#: Fixed by the contract: marks counted as symbols, and the limits of the counting rules.
SYMBOL_MARKS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[[ord(c) for c in SYMBOL_MARKS]] = True


def base_counts(column: pa.Array) -> dict[str, np.ndarray]:
    """The counting rules' figures of each text."""
    data, offsets = text_buffer(column)
    starts, ends, words = word_spans(data, offsets)
    n = len(words)

    def per_text(mask):
        sums = np.zeros(len(mask) + 1, np.int32)
        np.cumsum(mask, out=sums[1:])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    in_word = np.cumsum(inside[:-1], dtype=np.int8) > 0
    if len(starts):
        # adjacent words of neighbouring texts touch: a start on an end cancels, so mark starts again
        in_word[starts] = True
    chars = per_text(in_word & ((data & 0xC0) != 0x80))
    repeats = np.zeros(n, np.int64)
    if len(starts):
        window, per = shingles(hash_spans(data, starts, ends), words, 3)
        per = np.where(words >= 3, per, 0)
        first = np.cumsum(words) - words
        at = np.arange(int(per.sum())) - np.repeat(np.cumsum(per) - per, per) + np.repeat(first, per)
        keep = np.repeat(words >= 3, np.where(words >= 3, per, (words > 0).astype(np.int64)))
        window = window[keep]
        doc = np.repeat(np.arange(n), per).astype(np.uint64)
        twice = at[_repeated(mix(window + doc * np.uint64(0x9E3779B97F4A7C15)))]
        cover = np.zeros(len(starts) + 3, np.int64)
        np.add.at(cover, twice, 1)
        np.add.at(cover, twice + 3, -1)
        sums = np.concatenate([[0], np.cumsum(np.cumsum(cover)[:len(starts)] > 0)])
        repeats = sums[first + words] - sums[first]
    duplicates = np.zeros(n, np.int64)
    for i, text in enumerate(column.to_pylist()):
        lines = [x for x in text.split("\n") if x.strip(" \t\n\r\x0b\x0c")] if text else []
        duplicates[i] = len(lines) - len(set(lines))
    return {"n_words": words, "word_chars": chars, "n_symbols": per_text(_IS_SYMBOL[data]),
            "n_dup_lines": duplicates, "n_repeat_words": repeats}


def _repeated(hashes: np.ndarray) -> np.ndarray:
    """Places of the hashes that occur more than once."""
    ordered = np.sort(hashes)
    more = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    low = np.zeros(1 << 16, bool)
    low[more & np.uint64(0xFFFF)] = True
    maybe = np.flatnonzero(low[hashes & np.uint64(0xFFFF)])
    return maybe[np.isin(hashes[maybe], more)]


FIGURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, key, m (both as given) and the counting rules' figures."""

    def run(source):
        for batch in batches(source):
            figures = base_counts(batch.column(3))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0).cast(pa.int64()), "key": batch.column(1), "m": batch.column(2),
                **{k: pa.array(v.astype(np.int64)) for k, v in figures.items()}})

    return docs.select("doc_id", "key", "m", "text").mapInArrow(run, f"doc_id long, key long, m long, {FIGURES}")


def trigrams(m: np.ndarray, column: pa.Array):
    """Of all tokens end to end: text, place, hashes u, v, w and gram, whether it is scored; of texts: half and tokens."""
    w, scored, counts, half = text_tokens(column)
    text = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(w)) - np.repeat(np.cumsum(counts) - counts, counts)
    v, u = np.full(len(w), BORDER), np.full(len(w), BORDER)
    v[1:] = np.where(place[1:] >= 1, w[:-1], BORDER)
    u[2:] = np.where(place[2:] >= 2, w[:-2], BORDER)
    gram = mix(mix(mix(u + m.astype(np.uint64)[text]) + v) + w)
    return text, place, u, v, w, gram, scored, half, counts


def count_grams(docs: DataFrame) -> DataFrame:
    """gram, m, u, v, w and its counts n0, n1 in either half of the texts of model m."""

    def run(source):
        for batch in batches(source):
            m = batch.column(0).to_numpy()
            text, _, u, v, w, gram, _, half, _ = trigrams(m, batch.column(1))
            if not len(gram):
                continue
            own, first, back = np.unique(gram, return_index=True, return_inverse=True)
            of = half[text]
            n1 = np.bincount(back, of, len(own)).astype(np.int64)
            n0 = np.bincount(back, 1 - of, len(own)).astype(np.int64)
            yield pa.RecordBatch.from_pydict({
                "gram": pa.array(own.view(np.int64)), "m": pa.array(m[text[first]]),
                **{k: pa.array(x[first].view(np.int64)) for k, x in (("u", u), ("v", v), ("w", w))},
                "n0": pa.array(n0), "n1": pa.array(n1)})

    counted = docs.select("m", "text").mapInArrow(
        run, "gram long, m long, u long, v long, w long, n0 long, n1 long")
    return counted.groupBy("gram").agg(*[F.max(c).alias(c) for c in ("m", "u", "v", "w")],
                                       *[F.sum(c).alias(c) for c in ("n0", "n1")])


def context_stats(grams: DataFrame, *by: str) -> DataFrame:
    """Of each context, in either half: total, and grams counted once, twice and more often."""
    out = []
    for x in "01":
        n = F.col(f"n{x}")
        out += [F.sum(n).alias(f"t{x}"), F.count_if(n == 1).alias(f"a{x}"), F.count_if(n == 2).alias(f"b{x}"),
                F.count_if(n >= 3).alias(f"c{x}")]
    return grams.groupBy(*by).agg(*out)


def discounts(grams: DataFrame) -> DataFrame:
    """m, and three discounts of either half, by the counts of counts."""
    counts = grams.groupBy("m").agg(*[F.count_if(F.col(f"n{x}") == j).cast("double").alias(f"c{x}{j}")
                                      for x in "01" for j in (1, 2, 3, 4)])
    out = [F.col("m")]
    for x in "01":
        n1, n2, n3, n4 = (F.col(f"c{x}{j}") for j in (1, 2, 3, 4))
        y = F.when((n1 > 0) & (n2 > 0), n1 / (n1 + 2 * n2)).otherwise(0.5)
        for j, value, other, cap in ((1, 1 - 2 * y * n2 / F.nullif(n1, F.lit(0.0)), 0.5, 0.95),
                                     (2, 2 - 3 * y * n3 / F.nullif(n2, F.lit(0.0)), 1.0, 1.95),
                                     (3, 3 - 4 * y * n4 / F.nullif(n3, F.lit(0.0)), 1.5, 2.95)):
            out.append(F.greatest(F.lit(0.05), F.least(F.lit(cap), F.coalesce(value, F.lit(other)))).alias(f"d{x}{j}"))
    return counts.select(*out)


def interpolated(x: str, lower: Column) -> Column:
    """A gram's probability in half x, from its n, its context's stats and discounts, and its lower order."""
    n, t = F.col(f"n{x}"), F.col(f"t{x}")
    d1, d2, d3 = (F.col(f"d{x}{j}") for j in (1, 2, 3))
    cut = F.when(n >= 3, d3).when(n == 2, d2).when(n == 1, d1).otherwise(0.0)
    gamma = (d1 * F.col(f"a{x}") + d2 * F.col(f"b{x}") + d3 * F.col(f"c{x}")) / t
    return F.when(t > 0, (n - cut) / t + gamma * lower).otherwise(lower)


def probabilities(grams: DataFrame) -> DataFrame:
    """m, u, v, w, gram, and by the counts of half 0 and half 1 the probability of w after u, v (p0, p1) and alone (o0, o1)."""
    def seen():
        return [F.count_if(F.col(f"n{x}") > 0).alias(f"n{x}") for x in "01"]

    pairs, _ = written(grams.groupBy("m", "v", "w").agg(*seen()), "op6-pairs")
    words = pairs.groupBy("m", "w").agg(*seen())
    p = words.join(context_stats(words, "m"), "m").join(discounts(words), "m")
    types = words.groupBy("m").agg(*[(F.count_if(F.col(f"n{x}") > 0) + 1).alias(f"types{x}") for x in "01"])
    p = p.join(types, "m").select("m", "w", *[interpolated(x, 1 / F.col(f"types{x}")).alias(f"o{x}") for x in "01"])
    p = pairs.join(context_stats(pairs, "m", "v"), ["m", "v"]).join(p, ["m", "w"]).join(discounts(pairs), "m").select(
        "m", "v", "w", "o0", "o1", *[interpolated(x, F.col(f"o{x}")).alias(f"l{x}") for x in "01"])
    p = grams.join(context_stats(grams, "m", "u", "v"), ["m", "u", "v"]).join(p, ["m", "v", "w"]).join(
        discounts(grams), "m")
    return p.select("m", "u", "v", "w", "gram", "o0", "o1",
                    *[interpolated(x, F.col(f"l{x}")).alias(f"p{x}") for x in "01"])


def bands(rows: DataFrame, band: float) -> DataFrame:
    """m, low and high: the ends of each model's band over its rows' ``hard`` and ``easy``."""
    def median(of):
        return F.percentile_approx(of, 0.5, 10000)

    middle = rows.groupBy("m").agg(median("hard").alias("mh"), median("easy").alias("me"))
    spread = rows.join(middle, "m").groupBy("m", "mh", "me").agg(
        median(F.abs(F.col("hard") - F.col("mh"))).alias("dh"), median(F.abs(F.col("easy") - F.col("me"))).alias("de"))

    def width(d):
        return band * F.greatest(1.4826 * F.col(d), F.lit(LEAST_DEVIATION))

    return spread.select("m", (F.col("me") - width("de")).alias("low"), (F.col("mh") + width("dh")).alias("high"))


def scores(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(every row's figures, model m, hard and easy; hard and easy of the passing texts under each model)."""
    prepare(docs.sparkSession)
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    # rows of equal key are equal in all that is judged
    docs = docs.select("doc_id", "text", F.when(lang.isNotNull(), F.xxhash64(lang)).alias("m"),
                       F.xxhash64("doc_id", lang, "text").alias("key"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    measured, _ = written(measure(docs).withColumn("base_failed", failed), "op6-measured")
    own = measured.where("m is not null").groupBy("m").agg(F.count_if(~F.col("base_failed")).alias("n")).where(
        F.col("n") >= LEAST_TEXTS).select("m")
    own, _ = written(own, "op6-languages")
    texts = docs.select("key", "m", "text").join(own, "m", "left_semi")
    if not measured.join(own, "m", "left_anti").isEmpty():
        texts = texts.unionByName(docs.select("key", F.lit(MIXED).alias("m"), "text"))
    found, read = score(texts, PASSAGE, SHARE)
    scored, _ = written(found.groupBy("key", "m").agg(F.max("hard").alias("hard"), F.max("easy").alias("easy")), "op6-scored")
    drop_written(docs.sparkSession, *read)
    owned = own.withColumn("own", F.lit(True))
    rows = measured.join(owned, "m", "left").withColumn(
        "m", F.when(F.col("own"), F.col("m")).otherwise(F.lit(MIXED))).drop("own").join(scored, ["key", "m"], "left")
    passing = measured.where("not base_failed").select("key").join(scored, "key")
    return rows, passing


def judge(docs: DataFrame, band: float = BAND) -> DataFrame:
    """doc_id, figures, base_failed, kept, easy and hard of every document."""
    rows, passing = scores(docs)
    inside = (F.col("easy") >= F.col("low")) & (F.col("hard") <= F.col("high"))
    return rows.join(bands(passing, band), "m", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"), "easy", "hard")
