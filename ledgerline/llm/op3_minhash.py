"""Near-duplicate documents: universal hash minima, banding, verification and star contraction.

1. Per document: distinct word shingles, minima of many universal hashes
   (a x + b over 64-bit words), a 64-bit fingerprint of the set, and a key per band.
   The number of bands is set so that a pair at the threshold shares no band
   with a probability of at most ``MISS``.
2. Documents with equal sets form a class, named by the set's fingerprint; pairs,
   texts and components are of classes.
3. Candidates are pairs of classes in one bucket.  Members are ranked
   by how many others they meet in all their buckets, so the text that a group
   was copied from comes first.  First each bucket's first member is compared
   with all others.  Buckets that still touch several components stay open.  In
   open buckets of at most ``SMALL`` members, each member outside the largest
   component is compared with all.  For the members of larger open buckets,
   shingles that at most ``RARE`` of them have are rare: two members that share
   a rare shingle are a pair, and any other pair has its whole intersection
   among the other shingles, whose counts rule most pairs and members out.
   Members that remain take turns, a growing number a round, until the bucket
   is connected or all have had their turn.  So every pair of a bucket is
   compared, ruled out by counts or already connected, and a group of n near
   copies costs about n comparisons, not n squared.
4. A candidate whose signatures agree too little (six standard errors below
   the threshold) is dropped; the others are confirmed on their full sets.
5. Components by alternating large-star and small-star, carried from round to round:
   new links join the components found so far, so only those are contracted again.

Edge cases: a document without words (null, empty, white space) has an empty
set, no link and is kept.  Rows that repeat a doc_id each get a row; all their
sets are compared, and are one group as they share the id.  A null doc_id is
linked with nothing, has a null component and is kept.  Where ``row`` names a
column that tells rows apart, a shared doc_id links nothing, and a null one takes
part, after all others of its group.  An empty table gives no row.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import (batches, drop_written, hash_spans, lower_ascii, mix, need, prepare, shingles,
                     text_buffer, word_spans, written)
from .components import connected_components, joined_components

ROWS = 5
#: Largest probability that a pair at the threshold shares no band.
MISS = 1e-6
#: Members of a large bucket that take their turn in the first round; four times as many each round.
TURNS = 32
#: Buckets with no more members than this are finished in one round.
SMALL = 24
#: A shingle of so many members of large open buckets at most is rare.
RARE = 8

SIGNATURES = "doc_id long, row long, n_shingles long, rep long, sig array<long>, bands array<long>"
#: The lowest bit of each byte.
_LOWEST = 0x0101010101010101


def band_count(threshold: float, rows: int = ROWS, miss: float = MISS) -> int:
    return math.ceil(math.log(miss) / math.log1p(-threshold ** rows))


def text_shingles(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit shingle hashes, shingles per text), repeats included."""
    data, offsets = text_buffer(column)
    data = lower_ascii(data)
    starts, ends, counts = word_spans(data, offsets)
    return shingles(hash_spans(data, starts, ends), counts, k)


def fingerprints(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingles, fingerprint of the set) of each text; both are 0 without words."""
    ends = np.cumsum(counts)
    distinct, print_ = np.zeros(len(counts), np.int64), np.zeros(len(counts), np.uint64)
    for i in np.flatnonzero(counts).tolist():
        own = np.unique(values[ends[i] - counts[i]:ends[i]])
        distinct[i] = len(own)
        print_[i] = own.sum()
        print_[i:i + 1] = mix(mix(print_[i:i + 1] + np.uint64(len(own))) + mix(own + np.uint64(1)).sum())
    return distinct, print_.view(np.int64)


def signatures(docs: DataFrame, k: int, threshold: float) -> DataFrame:
    """One row per row of (doc_id, row, text); signature and bands are null without words."""
    bands = band_count(threshold)
    n = bands * ROWS
    rng = np.random.default_rng(7)
    factor = rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shift = rng.integers(0, 2**63, n, dtype=np.uint64)

    def run(source):
        for batch in batches(source):
            values, counts = text_shingles(batch.column(2), k)
            has = np.flatnonzero(counts)
            begin = (np.cumsum(counts) - counts)[has]
            distinct, rep = fingerprints(values, counts)
            minima = np.empty((len(has), n), np.uint64)
            if len(has):
                for j in range(n):
                    minima[:, j] = np.minimum.reduceat(values * factor[j] + shift[j], begin)
            keys = np.zeros((len(has), bands), np.uint64)
            for r in range(ROWS):
                keys = mix(keys + minima[:, r::ROWS])
            keys = (keys + np.arange(bands, dtype=np.uint64)).view(np.int64)
            low = np.zeros((len(has), -(-n // 8) * 8), np.uint8)
            low[:, :n] = (mix(minima) & np.uint64(255)).astype(np.uint8)
            low = low.view(np.int64)
            sig, band = [None] * len(counts), [None] * len(counts)
            for row, i in enumerate(has.tolist()):
                sig[i], band[i] = low[row], keys[row]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0).cast(pa.int64()), "row": batch.column(1), "n_shingles": pa.array(distinct),
                "rep": pa.array(rep), "sig": pa.array(sig, pa.list_(pa.int64())), "bands": pa.array(band, pa.list_(pa.int64()))})

    return need(docs, "doc_id", "row", "text").mapInArrow(run, SIGNATURES)


def _class_texts(texts: DataFrame, k: int) -> DataFrame:
    """rep and text: each text with the fingerprint of its set."""

    def run(source):
        for batch in batches(source):
            _, rep = fingerprints(*text_shingles(batch.column(0), k))
            yield pa.RecordBatch.from_pydict({"rep": pa.array(rep), "text": batch.column(0)})

    return need(texts, "text").mapInArrow(run, "rep long, text string")


def differing(a: str, b: str) -> Column:
    """In how many bytes two arrays of longs differ."""
    def folded(x: Column) -> Column:
        for bits in (4, 2, 1):
            x = x.bitwiseOR(F.shiftrightunsigned(x, bits))
        return F.bit_count(x.bitwiseAND(F.lit(_LOWEST)))

    return F.aggregate(F.zip_with(a, b, lambda x, y: x.bitwiseXOR(y)), F.lit(0), lambda n, x: n + folded(x))


def _agreeing(pairs: DataFrame, classes: DataFrame, most: int) -> DataFrame:
    """Pairs (a, b) whose signatures differ in at most ``most`` places."""
    sig = classes.select("rep", "sig")
    both = pairs.join(sig.withColumnsRenamed({"rep": "a", "sig": "sig_a"}), "a").join(
        sig.withColumnsRenamed({"rep": "b", "sig": "sig_b"}), "b")
    return both.where(differing("sig_a", "sig_b") <= most).select("a", "b")


def _confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs whose full sets reach ``100 * intersection >= percent * union``."""
    joined = pairs.join(texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b")), "b").join(
        texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a")), "a")

    def run(source):
        last, last_set = None, None
        for batch in batches(source):
            ids = batch.column(0).to_pylist()
            vb, cb = text_shingles(batch.column(3), k)
            eb = np.cumsum(cb)
            fresh = [i for i, a in enumerate(ids) if a != (ids[i - 1] if i else last)]
            va, ca = text_shingles(batch.column(2).take(pa.array(fresh, pa.int64())), k)
            ea = np.cumsum(ca)
            at = {row: j for j, row in enumerate(fresh)}
            keep = []
            for i, a in enumerate(ids):
                if i in at:
                    j = at[i]
                    last, last_set = a, np.unique(va[ea[j] - ca[j]:ea[j]])
                other = np.unique(vb[eb[i] - cb[i]:eb[i]])
                shared = len(np.intersect1d(last_set, other, assume_unique=True))
                keep.append(100 * shared >= percent * (len(last_set) + len(other) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return joined.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _occurrences(texts: DataFrame, k: int) -> DataFrame:
    """rep and shingle: the distinct shingles of each text."""

    def run(source):
        for batch in batches(source):
            values, counts = text_shingles(batch.column(1), k)
            own = np.cumsum(counts)
            sets = [np.unique(values[b - n:b]) for n, b in zip(counts, own)]
            if len(values):
                yield pa.RecordBatch.from_pydict({
                    "rep": pa.array(np.repeat(batch.column(0).to_numpy(), [len(s) for s in sets])),
                    "shingle": pa.array(np.concatenate(sets).view(np.int64))})

    return need(texts, "rep", "text").mapInArrow(run, "rep long, shingle long")


def _rare_shingles(texts: DataFrame, k: int) -> DataFrame:
    """rep and shingle, of shingles that at most ``RARE`` of the texts have."""
    found = _occurrences(texts, k).withColumn("texts", F.count("*").over(W.partitionBy("shingle")))
    rare, _ = written(found.where(F.col("texts") <= RARE), "op3-rare")
    return rare


def _rare_pairs(rare: DataFrame) -> DataFrame:
    """Distinct pairs a < b of texts that share a rare shingle; a list has at most ``RARE`` entries."""
    lists = rare.where("texts > 1").groupBy("shingle").agg(F.array_sort(F.collect_list("rep")).alias("reps"))
    return lists.select(F.posexplode("reps").alias("at", "a"), "reps").select(
        "a", F.explode(F.slice("reps", F.col("at") + 2, F.lit(RARE))).alias("b")).distinct()


@contextmanager
def _bloom(spark: SparkSession) -> Iterator[None]:
    """Joins in here drop most rows without a partner before the shuffle, by a Bloom filter of at most 8 MB."""
    prefix = "spark.sql.optimizer.runtime.bloomFilter"
    wanted = {f"{prefix}.enabled": "true", f"{prefix}.applicationSideScanSizeThreshold": "0",
              f"{prefix}.creationSideThreshold": "100GB", f"{prefix}.expectedNumItems": "4000000"}
    before = {key: spark.conf.get(key) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _shared_ids(signed: DataFrame) -> DataFrame:
    """Links a, b between the classes that hold one doc_id, one link a class."""
    ids = signed.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b")
    return signed.select("doc_id", F.col("rep").alias("b")).join(ids.select("doc_id", "a"), "doc_id").where(
        "a != b").select("a", "b").distinct()


def near_duplicates(docs: DataFrame, k: int = 3, percent: int = 85, row: str | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document.

    With ``row``, a column of longs that tells rows apart, that column too, and
    one row of each group is kept: that of the least doc_id, then of the least ``row``.
    """
    spark = docs.sparkSession
    prepare(spark)
    threshold = percent / 100
    docs = docs.select("doc_id", F.col(row).alias("row") if row else F.lit(0).cast("long").alias("row"), "text")
    signed, _ = written(signatures(docs, k, threshold), "op3-signatures")
    member = "n_shingles > 0" if row else "n_shingles > 0 and doc_id is not null"
    place = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "row")
    classes = signed.where(member).groupBy("rep").agg(
        F.min(place).alias("place"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"),
        F.first("bands").alias("bands"))
    classes, _ = written(classes, "op3-classes")

    rows = classes.select("rep", F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    rows = rows.withColumn("size", F.count("*").over(W.partitionBy("bucket"))).where("size > 1")
    # the centre of a group meets more of it, in more buckets, than the group's other members do
    members, members_path = written(rows.withColumn("degree", F.sum("size").over(W.partitionBy("rep"))), "op3-members")
    # the texts that any comparison may need, so that the whole table is joined once; of a repeated
    # doc_id all texts come, and find their class by the fingerprint of their set
    wanted = members.select("rep").distinct()
    held, held_path = written(wanted.join(classes, "rep").select("rep", "n_shingles", "place.doc_id", "place.row"), "op3-held")
    held = held.where("n_shingles > 0")  # true of all; the filter is built for sides that have one
    at = "row" if row else "doc_id"
    with _bloom(spark):
        texts = _class_texts(docs.join(held, docs[at] == held[at], "left_semi"), k)
        texts, texts_path = written(texts.join(held, "rep", "left_semi").groupBy("rep").agg(
            F.max("text").alias("text")), "op3-texts")
    drop_written(spark, held_path)
    hub = members.groupBy("bucket").agg(F.max_by(F.struct(
        F.col("rep").alias("a"), F.col("n").alias("na")), F.struct("degree", "rep")).alias("hub"))
    sized = 100 * F.least("n", "na") >= percent * F.greatest("n", "na")

    bands = band_count(threshold)
    n = bands * ROWS
    expect = threshold + (1 - threshold) / 256
    least = math.floor(n * expect - 6 * math.sqrt(n * expect * (1 - expect)))
    paths = [members_path, texts_path]
    same_id = _shared_ids(signed.where(member if row is None else "false"))
    component = connected_components(same_id.select(F.col("a").alias("u"), F.col("b").alias("v")))

    def confirm(pairs: DataFrame) -> None:
        """Verify distinct pairs, and join the components that new links touch."""
        nonlocal component
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
        found, path = written(_confirmed(_agreeing(pairs, classes, n - least), texts, k, percent), "op3-links")
        paths.append(path)
        component = joined_components(component, found.select(F.col("a").alias("u"), F.col("b").alias("v")))

    def opened(rows: DataFrame) -> DataFrame:
        """The rows of buckets that touch several components, with the bucket's largest as ``main``."""
        here = rows.join(component, rows["rep"] == component["node"], "left").select(
            *rows.columns, F.coalesce("component", "rep").alias("component"))
        here = here.repartition("bucket")  # the counts and the join need no other shuffle
        per = here.groupBy("bucket", "component").agg(F.count("*").alias("many"))
        main = per.groupBy("bucket").agg(
            F.count("*").alias("parts"), F.max_by("component", F.struct("many", "component")).alias("main"))
        still, path = written(here.join(main.where("parts > 1"), "bucket").drop("parts"), "op3-open")
        paths.append(path)
        return still

    def taking(rows: DataFrame, *more: str) -> DataFrame:
        return rows.select("bucket", F.col("rep").alias("a"), F.col("component").alias("ca"), F.col("n").alias("na"),
                           *[F.col(c).alias(f"{c}_a") for c in more])

    confirm(members.join(hub, "bucket").select("rep", "n", "hub.*").where(
        (F.col("rep") != F.col("a")) & sized).select("a", F.col("rep").alias("b")))
    still = opened(members)

    small, large = still.where(F.col("size") <= SMALL), still.where(F.col("size") > SMALL)
    apart = F.col("component") != F.col("ca")
    pairs = small.join(taking(small.where("component != main")), "bucket").where(apart & sized).select(
        "a", F.col("rep").alias("b"))
    crowd = large.select("rep").distinct()
    rare = _rare_shingles(texts.join(crowd, "rep", "left_semi"), k)
    known = large.select("rep", "n", "component").distinct()
    rare_pairs = _rare_pairs(rare).join(known.select(F.col("rep").alias("b"), "n", "component"), "b").join(
        known.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("component").alias("ca")), "a")
    confirm(pairs.union(rare_pairs.where(apart & sized).select("a", "b")))

    # what a member may share with one that has none of its rare shingles
    core = large.select("bucket", "rep", "degree", "n").join(
        rare.groupBy("rep").agg(F.count("*").alias("rare")), "rep", "left").select(
        "bucket", "rep", "degree", "n", (F.col("n") - F.coalesce("rare", F.lit(0))).alias("room"))
    core = core.where(100 * F.col("room") >= percent * F.col("n"))
    # a pair meets in the least of the buckets it shares; a member has one bucket a band at most
    own = F.collect_set("bucket").over(W.partitionBy("rep"))
    core, core_path = written(core.withColumn("own", own), "op3-core")
    paths.append(core_path)
    shared = F.least("room", "room_a")
    possible = (100 * shared >= percent * (F.col("n") + F.col("na") - shared)) & (
        F.array_min(F.array_intersect("own", "own_a")) == F.col("bucket"))
    turn = W.partitionBy("bucket").orderBy(F.desc("degree"), "rep")
    turns, done = TURNS, None
    while True:
        still = opened(core)
        waiting = still.where("component != main")
        if done is not None:
            waiting = waiting.join(done, ["bucket", "rep"], "left_anti")
        hubs = waiting.withColumn("turn", F.row_number().over(turn)).where(F.col("turn") <= turns)
        hubs, hubs_path = written(taking(hubs, "room", "own"), "op3-hubs")
        paths.append(hubs_path)
        if hubs.isEmpty():
            break
        confirm(still.join(hubs, "bucket").where(apart & possible).select("a", F.col("rep").alias("b")))
        taken = hubs.select("bucket", F.col("a").alias("rep"))
        done = taken if done is None else done.union(taken)
        turns *= 4

    names = classes.select("rep", "place").join(component, F.col("rep") == F.col("node"), "left").select(
        "rep", "place", F.coalesce("component", "rep").alias("component"))
    first = names.groupBy("component").agg(F.min("place").alias("first"))
    names, _ = written(names.join(first, "component").select("rep", "first"), "op3-components")
    drop_written(spark, *paths)
    joined = signed.withColumn("takes", F.expr(f"coalesce({member}, false)")).join(names, "rep", "left")
    return joined.select(
        "doc_id", *([F.col("row").alias(row)] if row else []), "n_shingles",
        F.when(F.col("takes"), F.col("first.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        (~F.col("takes") | F.coalesce(place.eqNullSafe(F.col("first")), F.lit(True))).alias("kept"))
