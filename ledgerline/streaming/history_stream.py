"""Incremental version history (streaming target with late-row placement).

Storage: two append-only folders under ``root``.

* ``log/batch_id=N/scd_bucket=b/scd_range=r``: every change row received, as
  received, laid out by key bucket and sequence range (the year of a date or
  timestamp, else the number divided by ``range_width``); each file's footer
  holds its least and greatest sequence.
* ``history/batch_id=N/scd_bucket=b``: the versions that commit N changed, and
  a tombstone (``scd_deleted``) for each version that it merged away.

N is a commit number that only grows.  ``_commits/N=run,batch`` records which
run (a stream checkpoint) and micro-batch it belongs to before anything is
written, so a replayed batch finds its own number and replaces itself, and a
stream restarted with a new checkpoint (batch ids from 0 again) gets new
numbers and never overwrites earlier commits; ``_commits/N=done`` follows when the
batch is applied.  A folder counts only once it holds ``_SUCCESS``, which the
writer's job commit leaves last.

``apply_batch(batch, id, run)`` (the ``foreachBatch`` function) splices:

1. the batch is written to its log folder;
2. per touched key, the stored versions from the one before the batch's least
   sequence to the one after its greatest are the *region* (two aggregates and
   a join by key; buckets pruned by name);
3. a version of the region that no batch row falls into is known by its first
   and its last row, both stored: ``__START_AT`` and the sequence column.  Only a
   version that is *cut* needs its change rows, and only then is the log read:
   the buckets and ranges of the cut versions, and inside them the rows between
   their least and greatest sequence.  A batch that only appends reads no log;
4. ``apply_scd2`` over these rows gives the region anew; versions that differ
   from the stored ones are written, others are left.  A late row into a key
   with any number of versions writes three rows at most.

A batch that holds a large part of the log (one row to ``REBUILD`` logged before it)
in every stored bucket touches most versions; splicing would move them several
times.  Its commit is *whole* instead: the versions of all logged rows, by one
shuffle on bucket and part of a bucket, in which the rebuild and the write
both stay.  ``history/_whole`` names such commits, and readers begin at the latest.  As
the log grows by a share each time, all rebuilds together read it a bounded
number of times.

``history()`` resolves merge-on-read: per key and version start, the row of the
latest commit, without tombstones; a whole commit alone is read as it is.
Late rows are placed by sequence because a cut version is rebuilt from the log:
collapsed A@1, A@4, A@5 must become A[1,3) B[3,4) A[4,inf) when B@3 arrives.

``compact_log`` and ``compact_history`` fold old commits into a new folder below
all others, and delete the old ones only after it is committed, oldest first,
so that at every moment the newest surviving row of each version is right.
With ``retention_s`` the old folders stay for readers that have listed them;
``vacuum`` deletes them later.  ``foreachBatch`` is at-least-once; every step
is idempotent, so the end state is exactly-once.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.constants import CURRENT, END_AT, START_AT
from ledgerline.operators.scd2 import DEFAULT_ROWS_PER_CHUNK, apply_scd2, deduplicate_changes
from ledgerline.session import hand_off

BUCKET = "scd_bucket"
RANGE = "scd_range"
BATCH = "batch_id"
DELETED = "scd_deleted"
#: Part of a bucket: what one task rebuilds.
PART = "scd_part"
#: Logged rows to one new row up to which versions are built anew rather than spliced.
REBUILD = 4
_STOP = "_scd_stop"


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on keys that may be NULL; the right side's other columns are added."""
    other = right.select(*[F.col(k).alias(f"_s_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        term = left[k].eqNullSafe(other[f"_s_{k}"])
        cond = term if cond is None else cond & term
    out = left.join(other, cond, how)
    return out if how == "left_semi" else out.drop(*[f"_s_{k}" for k in keys])


class ChangeLogHistory:
    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], sequence_by: str,
                 track_history: Sequence[str] | None = None, buckets: int = 64,
                 fmt: str = "parquet", range_width: int = 1 << 20, **scd_options):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keys = list(keys)
        self.sequence_by = sequence_by
        self.track_history = list(track_history) if track_history is not None else None
        self.buckets = buckets
        self.fmt = fmt
        self.range_width = range_width
        self.scd_options = scd_options
        self._run = "direct"  # until ``start`` takes the checkpoint's

    @property
    def log_path(self) -> str:
        return f"{self.root}/log"

    @property
    def history_path(self) -> str:
        return f"{self.root}/history"

    def _bucket(self):
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _range(self, schema: T.StructType, value=None):
        """The sequence range of a value (by default of a row), as a partition number that rises with it."""
        dtype = schema[self.sequence_by].dataType
        value = F.col(self.sequence_by) if value is None else value
        if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            out = F.year(value)
        elif isinstance(dtype, T.NumericType):
            out = F.floor(value / self.range_width)
        else:  # text has no width
            out = F.lit(0)
        return F.coalesce(out.cast("int"), F.lit(0))

    # -- file system helpers (names only; no data through the driver) -------
    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def children(self, path: str, prefix: str) -> list[int]:
        """Int values of ``prefix=`` sub-folders of ``path`` (Hadoop listing)."""
        p, fs = self._fs(path)
        if not fs.exists(p):
            return []
        names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
        return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith(f"{prefix}="))

    def _committed(self, folder: str) -> list[int]:
        """Commit numbers of ``folder`` whose write has finished and left rows."""
        out = []
        for n in self.children(folder, BATCH):
            p, fs = self._fs(f"{folder}/{BATCH}={n}")
            names = [st.getPath().getName() for st in fs.listStatus(p)]
            if "_SUCCESS" in names and any(x.startswith(f"{BUCKET}=") for x in names):
                out.append(n)
        return out

    def _load(self, folder: str, commits: Sequence[int]) -> DataFrame:
        return (self.spark.read.format(self.fmt).option("basePath", folder)
                .load([f"{folder}/{BATCH}={n}" for n in commits]))

    def _markers(self) -> dict[str, int]:
        """owner or ``done:N`` -> commit number, from one listing."""
        p, fs = self._fs(f"{self.root}/_commits")
        known = {}
        if fs.exists(p):
            for st in fs.listStatus(p):
                number, _, who = st.getPath().getName().partition("=")
                known[f"done:{number}" if who == "done" else who] = int(number)
        return known

    def _mark(self, number: int, what: str) -> None:
        marker, fs = self._fs(f"{self.root}/_commits/{number}={what}")
        if not fs.mkdirs(marker):
            raise RuntimeError(f"could not record commit {number}")

    def _commit_number(self, run: str, batch_id: int) -> int:
        """The number of this run's micro-batch: its own if it was begun before, else the next one."""
        owner = f"{run},{batch_id}"
        known = self._markers()
        if owner in known:
            return known[owner]
        taken = [*known.values(), *self.children(self.log_path, BATCH),
                 *self.children(self.history_path, BATCH), -1]
        number = max(taken) + 1
        self._mark(number, owner)
        return number

    def _run_of(self, checkpoint: str) -> str:
        """The id kept beside a stream checkpoint; a new checkpoint gets a new one."""
        p, fs = self._fs(f"{checkpoint}/_history_run")
        if fs.exists(p):
            return fs.listStatus(p)[0].getPath().getName()
        run = uuid.uuid4().hex
        marker, _ = self._fs(f"{checkpoint}/_history_run/{run}")
        if not fs.mkdirs(marker):
            raise RuntimeError(f"could not record the run of {checkpoint}")
        return run

    def _folded(self, folder: str) -> dict[int, int]:
        """Compaction's number -> the last commit it stands for."""
        p, fs = self._fs(f"{folder}/_folded")
        if not fs.exists(p):
            return {}
        names = [st.getPath().getName() for st in fs.listStatus(p)]
        return {int(n.partition("=")[0]): int(n.partition("=")[2]) for n in names}

    def _live(self) -> list[int]:
        """History commits that count: from the latest whole one on, and compactions that took it in."""
        commits = self._committed(self.history_path)
        whole = [n for n in self.children(f"{self.history_path}/_whole", BATCH) if n in commits]
        if not whole:
            return commits
        folded = self._folded(self.history_path)
        return [n for n in commits if n >= whole[-1] or folded.get(n, n) >= whole[-1]]

    def _touched_buckets(self, batch_dirs: Sequence[str]) -> list[int]:
        return sorted({b for d in batch_dirs for b in self.children(d, BUCKET)})

    def _write(self, df: DataFrame, folder: str, placed: bool = False) -> None:
        """Overwrite ``folder`` partitioned by key bucket (and sequence range, in
        the log): rows are rebalanced on these first (about one file each; AQE splits
        one holding a large share over several tasks) and sorted inside each
        file, which keeps per-file min/max statistics tight.  ``placed`` rows bring
        their bucket and lie by bucket and part already: no shuffle."""
        out, by = df if placed else df.withColumn(BUCKET, self._bucket()), [BUCKET]
        if folder.startswith(f"{self.log_path}/"):
            out, by = out.withColumn(RANGE, self._range(df.schema)), [BUCKET, RANGE]
        order = [*self.keys, self.sequence_by] if RANGE in by else self.keys
        out = out if placed else out.hint("rebalance", *by)
        (out.sortWithinPartitions(*by, *order)
            .write.format(self.fmt).mode("overwrite").partitionBy(*by).save(folder))

    def _part(self):
        """The part of its bucket that a key lies in; all parts together are some more than the shuffle's partitions."""
        total = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return F.pmod(F.hash(*[F.col(k) for k in self.keys]), F.lit(max(1, -(-2 * total // self.buckets))))

    # -- the foreachBatch function --------------------------------------------
    def apply_batch(self, batch: DataFrame, batch_id: int, run: str | None = None) -> None:
        number = self._commit_number(run or self._run, batch_id)
        markers = self._markers()
        if f"done:{number}" in markers:
            return  # a replay of an applied batch
        self._write(batch, f"{self.log_path}/{BATCH}={number}")
        # batches that were logged but never applied (a run that was given up) are applied now
        lost = [n for n in self._committed(self.log_path)
                if n >= 0 and n != number and f"done:{n}" not in markers]
        pending = [number, *lost]
        touched = self._touched_buckets([f"{self.log_path}/{BATCH}={n}" for n in pending])
        if touched:
            folder = f"{self.history_path}/{BATCH}={number}"
            if self._is_whole(number, pending, touched):
                self._write(self._rebuilt(), folder, placed=True)
            else:
                rows = self._load(self.log_path, pending).drop(BATCH, BUCKET, RANGE)
                self._write(self._changed(rows, number, touched), folder)
        for n in pending:
            self._mark(n, "done")

    def _options(self, source: DataFrame) -> dict:
        """Options of the rebuild: a source of fewer rows than make a key hot needs no sample."""
        opts = dict(self.scd_options)
        hot = opts.get("rows_per_chunk", DEFAULT_ROWS_PER_CHUNK)
        if hot and "hot_keys" not in opts:
            if source.count() <= hot:  # from the files' footers
                opts["rows_per_chunk"] = 0
            else:
                opts.setdefault("sample_source", source)
        return opts

    def _is_whole(self, number: int, pending: Sequence[int], touched: list[int]) -> bool:
        """Whether this commit is built from the whole log; if so, that is recorded before it is written."""
        marker, fs = self._fs(f"{self.history_path}/_whole/{BATCH}={number}")
        if fs.exists(marker):
            return True  # an attempt that failed
        stored = self._touched_buckets([f"{self.history_path}/{BATCH}={n}" for n in self._live() if n != number])
        if not set(stored) <= set(touched):
            return False
        count = lambda commits: self._load(self.log_path, commits).count()  # noqa: E731  (from the files' footers)
        logged = self._committed(self.log_path)
        if stored and count(pending) * (REBUILD + 1) < count(logged):
            return False
        if not fs.mkdirs(marker):
            raise RuntimeError(f"could not record the whole commit {number}")
        return True

    def _rebuilt(self) -> DataFrame:
        """The versions of all logged rows, by bucket and part of a bucket."""
        log = self._load(self.log_path, self._committed(self.log_path)).drop(BATCH, RANGE).withColumn(PART, self._part())
        opts = self._options(log)
        if opts.get("hot_keys") is not None:
            opts["hot_keys"] = opts["hot_keys"].withColumn(BUCKET, self._bucket()).withColumn(PART, self._part())
        new = apply_scd2(log.repartition(BUCKET, PART), [BUCKET, PART, *self.keys], self.sequence_by,
                         self.track_history, **opts)
        return new.drop(PART).withColumn(DELETED, F.lit(False))

    def _changed(self, rows: DataFrame, number: int, touched: list[int]) -> DataFrame:
        """The versions that ``rows`` change, and tombstones of those that are no more."""
        # a folder of this number can only be a failed attempt's
        commits = [n for n in self._live() if n != number]
        stored = self._resolved(self._load(self.history_path, commits).where(F.col(BUCKET).isin(touched)), commits)
        region = self.region(stored, rows)
        tracked = self.track_history or [c for c in rows.columns if c not in self.keys and c != self.sequence_by]
        given = rows.columns
        intact = region.where("not _cut")
        feed = (rows.unionByName(intact.withColumn(self.sequence_by, F.col(START_AT)).select(*given))
                .unionByName(intact.select(*given)))
        source = rows
        span = region.where("_cut").agg(F.min(START_AT).cast("string").alias("lo"),
                                        F.max(self.sequence_by).cast("string").alias("hi")).first()
        if span["lo"] is not None:
            log = self.cut_log(span["lo"], span["hi"], touched)
            source = log.select(*given).unionByName(rows)
            feed = feed.unionByName(self.cut_rows(log, region.where("_cut")).select(*given))
        # where the region ends before a later version, that version's start stops its last one
        stops = region.where(F.col("_last") & F.col(END_AT).isNotNull()).withColumn(self.sequence_by, F.col(END_AT))
        feed = feed.withColumn(_STOP, F.lit(False)).unionByName(stops.select(*given, F.lit(True).alias(_STOP)))
        new = apply_scd2(feed, self.keys, self.sequence_by, [*tracked, _STOP], **self._options(source))
        new = new.where(~F.col(_STOP)).drop(_STOP)

        columns = new.columns
        whole = lambda df, name: df.select(
            *self.keys, START_AT, F.struct(*[F.col(c) for c in columns]).alias(name))
        a, b = whole(new, "_new").alias("a"), whole(region, "_old").alias("b")
        cond = F.col(f"a.{START_AT}") == F.col(f"b.{START_AT}")
        for k in self.keys:
            cond = cond & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
        both = a.join(b, cond, "full_outer").select("_new", "_old").where(~F.col("_new").eqNullSafe(F.col("_old")))
        kept = F.coalesce("_new", "_old")
        return both.select(*[kept[c].alias(c) for c in columns], F.col("_new").isNull().alias(DELETED))

    def region(self, stored: DataFrame, rows: DataFrame) -> DataFrame:
        """Stored versions that ``rows`` may change, with ``_cut`` and ``_last`` (the last of its key's region).

        Per key: from the version before the one that holds the least sequence
        to the one after the greatest.  A cut version's own rows lie around a new one.
        """
        seq = F.col(self.sequence_by)
        asked = (rows.where(seq.isNotNull()).groupBy(*self.keys)
                 .agg(F.min(seq).alias("_lo"), F.max(seq).alias("_hi")))
        near = _null_safe(stored, asked, self.keys)
        edge = near.groupBy(*self.keys).agg(
            F.max(F.when(F.col(START_AT) <= F.col("_lo"), F.col(START_AT))).alias("_from"),
            F.min(F.when(F.col(START_AT) > F.col("_hi"), F.col(START_AT))).alias("_to"))
        near = _null_safe(near, edge, self.keys).where(
            (F.col("_from").isNull() | F.col(END_AT).isNull() | (F.col(END_AT) >= F.col("_from")))
            & (F.col("_to").isNull() | (F.col(START_AT) <= F.col("_to"))))
        cut = (F.col(START_AT) <= F.col("_hi")) & (seq >= F.col("_lo"))
        last = F.coalesce(F.col(START_AT) == F.col("_to"), F.lit(False))
        return hand_off(near.select(*stored.columns, cut.alias("_cut"), last.alias("_last")), "history-region")

    def cut_log(self, lo: str, hi: str, touched: list[int]) -> DataFrame:
        """The log of the touched buckets and of the sequence ranges from ``lo`` to ``hi``."""
        log = self._load(self.log_path, self._committed(self.log_path)).where(F.col(BUCKET).isin(touched))
        dtype = log.schema[self.sequence_by].dataType
        lo, hi = F.lit(lo).cast(dtype), F.lit(hi).cast(dtype)
        return log.where(F.col(RANGE).between(self._range(log.schema, lo), self._range(log.schema, hi))
                         & F.col(self.sequence_by).between(lo, hi))

    def cut_rows(self, log: DataFrame, cut: DataFrame) -> DataFrame:
        """The logged change rows of cut versions (of one key these lie side by side)."""
        spans = cut.groupBy(*self.keys).agg(F.min(START_AT).alias("_lo"), F.max(self.sequence_by).alias("_hi"))
        return _null_safe(log, spans, self.keys).where(F.col(self.sequence_by).between(F.col("_lo"), F.col("_hi")))

    def history(self) -> DataFrame:
        """Current content: per key and version start, the row of the latest commit."""
        commits = self._live()
        if not commits:
            raise ValueError(f"no batch has been applied to {self.root} yet")
        return self._resolved(self._load(self.history_path, commits), commits)

    def _resolved(self, h: DataFrame, commits: Sequence[int]) -> DataFrame:
        """The versions of ``h``, rows of ``commits``, each by its latest commit."""
        last = h.where(~F.col(DELETED))
        if len(commits) > 1:  # one commit holds a version once
            order = Window.partitionBy(*self.keys, START_AT).orderBy(F.desc(BATCH))  # a version has few rows: one shuffle, one sort
            last = h.withColumn("_n", F.row_number().over(order)).where((F.col("_n") == 1) & ~F.col(DELETED))
        return last.select(*[c for c in h.columns if c not in (BATCH, BUCKET, RANGE, DELETED)])

    # -- compaction ---------------------------------------------------------
    def _publish(self, df: DataFrame, folder: str, upto: int, retention_s: float, placed: bool = False) -> str:
        """Write ``df`` as a new commit below all others, which stands for those up to ``upto``."""
        number = min([0, *self.children(folder, BATCH)]) - 1
        marker, fs = self._fs(f"{folder}/_folded/{number}={upto}")
        if not fs.mkdirs(marker):
            raise RuntimeError(f"could not record compaction {number}")
        target = f"{folder}/{BATCH}={number}"
        self._write(df, target, placed)
        self._vacuum(folder, retention_s)
        return target

    def _vacuum(self, folder: str, retention_s: float) -> None:
        """Delete commits that a compaction older than ``retention_s`` seconds stands for.

        From the logically oldest: earlier compactions (least negative first,
        each newer one lies lower), then batches in order.
        """
        done = set(self._committed(folder))
        ripe = []
        for number, upto in self._folded(folder).items():
            if number in done:
                success, fs = self._fs(f"{folder}/{BATCH}={number}/_SUCCESS")
                age = time.time() - fs.getFileStatus(success).getModificationTime() / 1000
                if age >= retention_s or retention_s <= 0:
                    ripe.append((number, upto))
        gone = {n for c, upto in ripe for n in self.children(folder, BATCH) if (n <= upto if n >= 0 else n > c)}
        for b in sorted(gone, key=lambda n: (n >= 0, abs(n))):
            p, fs = self._fs(f"{folder}/{BATCH}={b}")
            if not fs.delete(p, True):
                raise RuntimeError(f"could not delete {p}; repeat the compaction")

    def vacuum(self, retention_s: float = 0.0) -> None:
        """Delete what compactions older than ``retention_s`` seconds have replaced."""
        self._vacuum(self.log_path, retention_s)
        self._vacuum(self.history_path, retention_s)

    def compact_log(self, upto_commit: int, retention_s: float = 0.0) -> str:
        """Fold log commits ``<= upto_commit`` into one, reduced by rule 1 (all a rebuild reads)."""
        markers = self._markers()
        old = [b for b in self._committed(self.log_path) if b <= upto_commit]
        waiting = [b for b in old if b >= 0 and f"done:{b}" not in markers]
        old = [b for b in old if not waiting or b < min(waiting)]  # a batch that is not applied yet stays
        if not old:
            return ""
        log = self._load(self.log_path, old).drop(BATCH, RANGE).withColumn(PART, self._part())
        once = deduplicate_changes(log.repartition(BUCKET, PART), [BUCKET, PART, *self.keys], self.sequence_by)
        given = [c for c in log.columns if c != PART]
        return self._publish(once.select(*given), self.log_path, max(old), retention_s, placed=True)

    def compact_history(self, upto_commit: int, retention_s: float = 0.0) -> str:
        """Fold history commits ``<= upto_commit`` into one (versions that later
        commits changed still resolve to those)."""
        old = [b for b in self._live() if b <= upto_commit]
        if not old:
            return ""
        folded = self._resolved(self._load(self.history_path, old), old).withColumn(DELETED, F.lit(False))
        known = self._folded(self.history_path)
        return self._publish(folded, self.history_path, max(known.get(b, b) for b in old), retention_s)

    compact = compact_log

    # -- streaming ------------------------------------------------------------
    def start(self, changes: DataFrame, checkpoint: str | None = None,
              available_now: bool = True, processing_time: str | None = None):
        """Start a streaming query feeding ``changes`` (a streaming DataFrame)."""
        checkpoint = checkpoint or f"{self.root}/_checkpoint"
        self._run = self._run_of(checkpoint)
        writer = (changes.writeStream.foreachBatch(self.apply_batch)
                  .option("checkpointLocation", checkpoint))
        if available_now:
            writer = writer.trigger(availableNow=True)
        elif processing_time:
            writer = writer.trigger(processingTime=processing_time)
        return writer.start()


def stream_history(spark: SparkSession, source_dir: str, schema, root: str,
                   keys: Sequence[str], sequence_by: str,
                   track_history: Sequence[str] | None = None,
                   files_per_batch: int = 1, buckets: int = 64,
                   timeout_s: float | None = None, checkpoint: str | None = None, **scd_options) -> DataFrame:
    """Run a file-source stream of change rows to completion; return the history.

    The source folder is read with an explicit schema; each trigger takes
    ``files_per_batch`` new files.  Streams of several folders into one ``root`` have a
    ``checkpoint`` each.
    """
    target = ChangeLogHistory(spark, root, keys, sequence_by, track_history, buckets,
                              **scd_options)
    stream = (spark.readStream.schema(schema)
              .option("maxFilesPerTrigger", files_per_batch).parquet(source_dir))
    query = target.start(stream, checkpoint)
    finished = query.awaitTermination(timeout_s) if timeout_s else query.awaitTermination()
    if finished is False:
        query.stop()
        raise TimeoutError("history stream did not finish in time")
    if query.exception():
        raise query.exception()
    return target.history()
