"""Version history (slowly changing dimension, type 2) from a change feed.

``apply_scd2(changes, keys, sequence_by, track_history)`` turns change rows into
versions with ``__START_AT``, ``__END_AT`` (NULL while current) and
``__CURRENT``.  Rules:

1. Rows with a NULL sequence are dropped.  Of several rows with the same
   (keys, sequence) the one with the largest struct of the other columns is
   kept (a deterministic choice, independent of arrival order).
2. Per key, in sequence order, a row starts a new version when any tracked
   column differs (null-safe) from the previous row; the first row always does.
3. Untracked columns do not start versions; a version shows the values of its
   last row.
4. ``__START_AT`` is the first sequence of the version, ``__END_AT`` the start
   of the next version.  A -> B -> A gives three versions; A -> A gives one.
5. No deletes: a key that stops appearing keeps its last version current.

Because the result depends only on the set of change rows, rebuilding from an
append-only change log places late rows correctly (see ``streaming``).

Plan and scale
--------------
* Rules 1-4 are window passes over ``partitionBy(keys)`` ordered by (sequence,
  other columns descending): the first row of a tie is kept, then lag/lead and a
  running max find version starts and ends.  All windows share one shuffle and
  one sort; no sort-based aggregate is needed.
* A window keeps a whole key in one task.  Keys estimated (from a sample) to hold
  more than ``rows_per_chunk`` rows are *hot* and take a segmented scan instead:

  1. rule 1 by an aggregation, which combines copies and ties inside every map
     task, then range partitioning by (key, sequence), written to the shared
     folder with the number of the range;
  2. an edge summary of each range and key: first and last tracked values, first
     sequence, last version start inside the range;
  3. the summaries of a key, in range order, are folded into a carry: the last
     tracked values and the last start before the range, the first values and
     sequence after it (lag, lead and a running max: one row per range);
  4. the windows of the single pass run inside each range, with the carry at its
     two ends.

  Hot keys, ranges and carries are DataFrames; their number has no bound and
  none of them passes through the driver.  Ranges are cut at sample quantiles
  of (key, sequence) by Spark's range partitioning, so a burst is split as well.
  The sample only decides which way a key takes; both give the same versions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.constants import CURRENT, END_AT, START_AT
from ledgerline.session import hand_off

DEFAULT_ROWS_PER_CHUNK = 2_000_000
DEFAULT_SAMPLE_FRACTION = 0.001

_R = "_scd_range"


def deduplicate_changes(df: DataFrame, keys: Sequence[str], sequence_by: str) -> DataFrame:
    """Rule 1 as a standalone step: drop NULL sequences; one row per
    (keys, sequence), the largest struct of the other columns."""
    others = [c for c in df.columns if c not in keys and c != sequence_by]
    if not others:
        return df.where(F.col(sequence_by).isNotNull()).select(*keys, sequence_by).distinct()
    return (df.where(F.col(sequence_by).isNotNull())
            .groupBy(*keys, sequence_by)
            .agg(F.max(F.struct(*others)).alias("_r"))
            .select(*keys, sequence_by, *[F.col("_r")[c].alias(c) for c in others]))


def count_null_sequences(df: DataFrame, sequence_by: str) -> DataFrame:
    """Rule 1's dropped rows: how many change rows have no sequence value."""
    return df.agg(F.count_if(F.col(sequence_by).isNull()).alias("null_sequence_rows"))


def find_hot_keys(df: DataFrame, keys: Sequence[str], sequence_by: str,
                  rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK,
                  sample_fraction: float = DEFAULT_SAMPLE_FRACTION, seed: int = 7) -> DataFrame:
    """Keys estimated to hold more than ``rows_per_chunk`` change rows, with the estimate ``_rows``.

    A lazy aggregate over a sample of the key and sequence columns; it has at
    most (rows / rows_per_chunk) rows and stays a DataFrame.
    """
    src = df.where(F.col(sequence_by).isNotNull()).select(*keys)
    if sample_fraction < 1.0:
        src = src.sample(fraction=sample_fraction, seed=seed)
    return (src.groupBy(*keys).agg((F.count(F.lit(1)) / sample_fraction).alias("_rows"))
            .where(F.col("_rows") > rows_per_chunk))


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join on columns that may be NULL (a NULL key is a key like any other)."""
    renamed = right.select(*[F.col(c).alias(f"_j_{c}") for c in on],
                           *[c for c in right.columns if c not in on])
    cond = None
    for c in on:
        term = left[c].eqNullSafe(renamed[f"_j_{c}"])
        cond = term if cond is None else cond & term
    out = left.join(renamed, cond, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"_j_{c}" for c in on])


def split_ranges(rows: DataFrame, keys: Sequence[str], sequence_by: str,
                 ranges: int | None = None) -> DataFrame:
    """``rows`` by rule 1, range-partitioned by (keys, sequence) and written, with the range's number ``_scd_range``.

    A range's rows lie before those of the next one.  ``ranges`` defaults to the
    session's shuffle partitions, which AQE coalesces when they are small.
    """
    order = [*keys, sequence_by]
    one = deduplicate_changes(rows, keys, sequence_by)
    cut = one.repartitionByRange(ranges, *order) if ranges else one.repartitionByRange(*order)
    return hand_off(cut.withColumn(_R, F.spark_partition_id()), "scd2-ranges")


def range_carries(ranged: DataFrame, keys: Sequence[str], sequence_by: str, tracked: Sequence[str]) -> DataFrame:
    """What each (key, range) must know of its neighbours: one row each.

    ``_prev``: tracked values before the range; ``_next`` and ``_next_seq``: those and the
    sequence after it; ``_carry``: the last version start before it.
    """
    seq, values = F.col(sequence_by), F.struct(*[F.col(c) for c in tracked])
    here = Window.partitionBy(_R, *keys).orderBy(seq)
    before = F.lag(values).over(here)
    marked = ranged.select(*keys, _R, seq.alias("_s"), values.alias("_t"), F.when(
        F.lag(seq).over(here).isNotNull() & ~before.eqNullSafe(values), seq).alias("_start"))
    edges = marked.groupBy(_R, *keys).agg(
        F.min("_s").alias("_first_seq"), F.min_by("_t", "_s").alias("_first"),
        F.max_by("_t", "_s").alias("_last"), F.max("_start").alias("_inner"))
    along = Window.partitionBy(*keys).orderBy(_R)
    edges = edges.select("*", F.lag("_last").over(along).alias("_prev"), F.lead("_first").over(along).alias("_next"),
                         F.lead("_first_seq").over(along).alias("_next_seq"))
    opens = F.col("_prev").isNull() | ~F.col("_prev").eqNullSafe(F.col("_first"))
    last_start = F.coalesce("_inner", F.when(opens, F.col("_first_seq")))
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    return edges.select(*keys, _R, "_prev", "_next", "_next_seq", F.max(last_start).over(earlier).alias("_carry"))


def _collapse(rows: DataFrame, group: Sequence[str], sequence_by: str, tracked: Sequence[str],
              columns: Sequence[str], carried: bool) -> DataFrame:
    """Rules 2-4 inside each ``group``, whose rows have one sequence each; ``carried`` rows bring their group's carry."""
    seq, values = F.col(sequence_by), F.struct(*[F.col(c) for c in tracked])
    w = Window.partitionBy(*group).orderBy(seq)

    def with_edge(inside: Column, edge: str) -> Column:
        return F.coalesce(inside, F.col(edge)) if carried else inside

    marked = rows.select(
        "*", values.alias("_t"), with_edge(F.lag(values).over(w), "_prev").alias("_before"),
        with_edge(F.lead(values).over(w), "_next").alias("_after"),
        with_edge(F.lead(seq).over(w), "_next_seq").alias("_end"))
    differs = lambda c: F.col(c).isNull() | ~F.col(c).eqNullSafe(F.col("_t"))
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    started = marked.withColumn("_start", F.max(F.when(differs("_before"), seq)).over(running))
    return started.where(differs("_after")).select(
        *columns, with_edge(F.col("_start"), "_carry").alias(START_AT), F.col("_end").alias(END_AT),
        F.col("_end").isNull().alias(CURRENT))


def apply_scd2(changes: DataFrame, keys: Sequence[str], sequence_by: str,
               track_history: Sequence[str] | None = None,
               except_columns: Sequence[str] = (),
               ignore_null_updates: bool = False,
               rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK,
               sample_fraction: float = DEFAULT_SAMPLE_FRACTION,
               hot_keys: DataFrame | None = None,
               ranges: int | None = None,
               sample_source: DataFrame | None = None) -> DataFrame:
    """Versions of every key of ``changes`` (see module doc for the rules).

    ``track_history`` defaults to every column other than keys and sequence.
    Unless ``hot_keys`` is given or ``rows_per_chunk=0``, building the plan
    runs one small job (an aggregate over a sample of keys); if that finds hot
    keys, their rows are written in ranges at once.  ``hot_keys`` may be given as a
    DataFrame of the key columns to skip the sample; ``rows_per_chunk=0`` disables
    splitting; ``ranges`` is the number of ranges of the hot rows (default: the
    session's shuffle partitions).  ``sample_source`` (same key and sequence
    columns) may replace ``changes`` for the sample when it is cheaper to scan
    and holds at least as many rows per key, e.g. the source scans of a feed
    built by joins and aggregations; only the split depends on it.
    """
    if ignore_null_updates:
        raise NotImplementedError("ignore_null_updates=True is not supported")
    keys = list(keys)
    df = changes.drop(*except_columns) if except_columns else changes
    values = [c for c in df.columns if c not in keys and c != sequence_by]
    tracked = list(track_history) if track_history is not None else values
    bad = [c for c in tracked if c not in values]
    if bad:
        raise ValueError(f"tracked columns must be non-key, non-sequence columns: {bad}")
    seq = F.col(sequence_by)
    rows = df.where(seq.isNotNull())

    if hot_keys is None and rows_per_chunk > 0:
        probe = sample_source if sample_source is not None else df
        found = find_hot_keys(probe, keys, sequence_by, rows_per_chunk, sample_fraction)
        if not found.isEmpty():
            hot_keys = hand_off(found.select(*keys), "scd2-hot")  # both sides must see the same keys

    # One shuffle by key and one sort by (sequence, other columns descending)
    # serve every window below.  Rule 1: of rows sharing a sequence the first
    # in this order (largest struct) is kept.  The columns are ordered one by one:
    # a struct of them would be shuffled beside them.
    cold = rows if hot_keys is None else null_safe_join(rows, hot_keys.select(*keys), keys, "left_anti")
    w_tie = Window.partitionBy(*keys).orderBy(seq, *[F.col(c).desc() for c in values])
    cold = (cold.withColumn("_dup", F.coalesce(F.lag(seq).over(w_tie) == seq, F.lit(False)))
            .where(~F.col("_dup")).drop("_dup"))
    out = _collapse(cold, keys, sequence_by, tracked, df.columns, carried=False)
    if hot_keys is None:
        return out

    hot = null_safe_join(rows, hot_keys.select(*keys), keys, "left_semi")
    ranged = split_ranges(hot, keys, sequence_by, ranges)
    carries = range_carries(ranged, keys, sequence_by, tracked)
    ranged = null_safe_join(ranged, carries, [*keys, _R], "inner")
    return out.unionByName(_collapse(ranged, [_R, *keys], sequence_by, tracked, df.columns, carried=True))
