

import pytest

from ledgerline.operators.scd2 import apply_scd2
from ledgerline.streaming import ChangeLogHistory, stream_history

SCHEMA = "k long, s long, t string, x long"


def nkey(v):
    """Sort key tolerating NULLs (NULL first)."""
    return tuple((x is not None, x) for x in v)


def rows_of(df):
    cols = ["k", "s", "t", "x", "__START_AT", "__END_AT", "__CURRENT"]
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=nkey)


def test_late_row_is_placed_by_sequence(spark, scratch):
    h = ChangeLogHistory(spark, scratch("late"), ["k"], "s", ["t"], buckets=4)
    with pytest.raises(ValueError):
        h.history()
    h.apply_batch(spark.createDataFrame([(1, 1, "A", 0), (1, 4, "A", 0), (1, 5, "A", 0)], SCHEMA), 0)
    assert [(r.t, r["__START_AT"], r["__END_AT"]) for r in h.history().collect()] == [("A", 1, None)]
    h.apply_batch(spark.createDataFrame([(1, 3, "B", 0)], SCHEMA), 1)
    got = sorted(((r.t, r["__START_AT"], r["__END_AT"]) for r in h.history().collect()), key=nkey)
    assert got == [("A", 1, 3), ("A", 4, None), ("B", 3, 4)]


def test_batch_rebuilds_only_touched_keys(spark, scratch):
    h = ChangeLogHistory(spark, scratch("touched"), ["k"], "s", ["t"], buckets=2)
    h.apply_batch(spark.createDataFrame([(k, 1, "A", 0) for k in range(10)], SCHEMA), 0)
    h.apply_batch(spark.createDataFrame([(4, 2, "B", 0), (None, 1, "A", 0)], SCHEMA), 1)
    delta = spark.read.parquet(f"{h.history_path}/batch_id=1")
    assert sorted((r.k is None, r.k) for r in delta.select("k").distinct().collect()) == \
        [(False, 4), (True, None)]
    assert h.history().count() == 12


def test_replayed_batch_and_untouched_buckets(spark, scratch):
    h = ChangeLogHistory(spark, scratch("replay"), ["k"], "s", ["t"], buckets=8)
    b0 = spark.createDataFrame([(k, 1, "A", 0) for k in range(20)], SCHEMA)
    b1 = spark.createDataFrame([(3, 2, "B", 0)], SCHEMA)
    h.apply_batch(b0, 0)
    h.apply_batch(b1, 1)
    h.apply_batch(b1, 1)          # replay after a failure: no duplicate
    expected = apply_scd2(b0.unionByName(b1), ["k"], "s", ["t"])
    assert rows_of(h.history()) == rows_of(expected)
    assert h.history().count() == 21


def test_stream_equals_batch(spark, scratch):
    root = scratch("stream")
    rows = [(k % 7, s, "AB"[(s // 3 + k) % 2], s) for k in range(30) for s in range(6)]
    feed = spark.createDataFrame(rows, SCHEMA)
    feed.repartition(4).write.parquet(f"{root}/source")
    hist = stream_history(spark, f"{root}/source", feed.schema, f"{root}/target", ["k"], "s",
                          ["t"], buckets=4, timeout_s=300)
    assert rows_of(hist) == rows_of(apply_scd2(feed, ["k"], "s", ["t"]))


def test_compaction_keeps_history(spark, scratch):
    h = ChangeLogHistory(spark, scratch("compact"), ["k"], "s", ["t"], buckets=4)
    rows = [(k, s, "AB"[(s + k) % 2], s) for k in range(6) for s in range(5)]
    for i in range(4):
        batch = spark.createDataFrame([r for j, r in enumerate(rows) if j % 4 == i], SCHEMA)
        h.apply_batch(batch, i)
        h.apply_batch(batch, i)              # replays are harmless
    before = rows_of(h.history())
    target = h.compact_log(2)
    assert target.endswith("batch_id=-1")     # a fresh number below all others
    ids = sorted(r[0] for r in spark.read.parquet(h.log_path).select("batch_id").distinct().collect())
    assert ids == [-1, 3]
    assert h.compact_history(3).endswith("batch_id=-1")
    assert rows_of(h.history()) == before
    late = spark.createDataFrame([(0, 100, "Z", 0)], SCHEMA)
    h.apply_batch(late, 4)
    after = rows_of(h.history())
    everything = spark.createDataFrame(rows + [(0, 100, "Z", 0)], SCHEMA)
    assert after == rows_of(apply_scd2(everything, ["k"], "s", ["t"]))
    assert len(after) == len(before) + 1


class _FailOnce(ChangeLogHistory):
    """Fails once in the middle of batch 1: after its log write, before the
    history delta, as if the job were lost there."""
    failed = False

    def apply_batch(self, batch, batch_id):
        if batch_id == 1 and not _FailOnce.failed:
            self._write(batch, f"{self.log_path}/batch_id={batch_id}")
            _FailOnce.failed = True
            raise RuntimeError("injected failure")
        super().apply_batch(batch, batch_id)


def test_stream_recovers_from_a_failed_batch(spark, scratch):
    root = scratch("recover")
    rows = [(k % 5, s, "AB"[(s + k) % 2], s) for k in range(20) for s in range(4)]
    feed = spark.createDataFrame(rows, SCHEMA)
    feed.repartition(3).write.parquet(f"{root}/source")

    def run():
        target = _FailOnce(spark, f"{root}/target", ["k"], "s", ["t"], buckets=4)
        stream = (spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", 1)
                  .parquet(f"{root}/source"))
        q = target.start(stream, checkpoint=f"{root}/ckpt")
        try:
            q.awaitTermination(300)
        except Exception:  # noqa: BLE001  (the injected failure surfaces here)
            pass
        return target, q

    _, q1 = run()
    assert q1.exception() is not None and _FailOnce.failed
    target, q2 = run()                       # restart from the checkpoint
    assert q2.exception() is None
    assert rows_of(target.history()) == rows_of(apply_scd2(feed, ["k"], "s", ["t"]))


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 12), st.sampled_from(["A", "B", None]),
                          st.integers(0, 1)), min_size=1, max_size=40),
       st.lists(st.integers(0, 2), min_size=40, max_size=40),
       st.integers(0, 2))
def test_any_split_and_replay_gives_the_batch_result(spark, scratch, rows, deal, replay):
    h = ChangeLogHistory(spark, scratch("split"), ["k"], "s", ["t"], buckets=2)
    batches = [[r for r, d in zip(rows, deal) if d == b] for b in range(3)]
    for b, part in enumerate(batches):
        if part:
            df = spark.createDataFrame(part, SCHEMA)
            h.apply_batch(df, b)
            if b == replay:
                h.apply_batch(df, b)
    assert rows_of(h.history()) == rows_of(apply_scd2(spark.createDataFrame(rows, SCHEMA),
                                                      ["k"], "s", ["t"]))


def _feed(spark, rows):
    return spark.createDataFrame(rows, "k long, seq long, v string")


def _versions(df):
    return sorted((r.k, r.v, r["__START_AT"], r["__END_AT"]) for r in df.collect())


def test_new_checkpoint_on_an_existing_root_loses_nothing(spark, scratch):
    from ledgerline.operators.scd2 import apply_scd2
    from ledgerline.streaming import ChangeLogHistory
    h = ChangeLogHistory(spark, scratch("restart"), ["k"], "seq", ["v"], buckets=2)
    rows = [[(1, 1, "A"), (2, 1, "X")], [(1, 3, "B")], [(1, 2, "C"), (3, 1, "Z")]]
    h.apply_batch(_feed(spark, rows[0]), 0, "first")
    h.apply_batch(_feed(spark, rows[1]), 1, "first")
    h.apply_batch(_feed(spark, rows[2]), 0, "second")  # a new checkpoint counts from 0 again
    h.apply_batch(_feed(spark, rows[2]), 0, "second")  # and may replay
    want = apply_scd2(_feed(spark, sum(rows, [])), ["k"], "seq", ["v"])
    assert _versions(h.history()) == _versions(want)


@pytest.mark.parametrize("fail_at", [0, 1, 2, 3])
def test_compaction_interrupted_at_any_step_keeps_the_history(spark, scratch, fail_at):
    from ledgerline.operators.scd2 import apply_scd2
    from ledgerline.streaming import ChangeLogHistory
    h = ChangeLogHistory(spark, scratch("compact"), ["k"], "seq", ["v"], buckets=2)
    rows = [[(1, 1, "A"), (2, 1, "X")], [(1, 3, "B")], [(1, 2, "C"), (3, 1, "Z")]]
    for i, r in enumerate(rows):
        h.apply_batch(_feed(spark, r), i)
    want = _versions(apply_scd2(_feed(spark, sum(rows, [])), ["k"], "seq", ["v"]))
    for compact in (h.compact_history, h.compact_log, h.compact_history, h.compact_log):
        real, steps = h._fs, [0]

        def failing(path, real=real, steps=steps):
            p, fs = real(path)

            class Files:
                def __getattr__(self, name):
                    if name == "delete":
                        steps[0] += 1
                        if steps[0] > fail_at:
                            raise OSError("lost")
                    return getattr(fs, name)
            return p, Files()

        h._fs = failing
        try:
            compact(2)
        except OSError:
            pass
        h._fs = real
        assert _versions(h.history()) == want
    h.apply_batch(_feed(spark, [(1, 5, "D")]), 3)
    rows.append([(1, 5, "D")])
    assert _versions(h.history()) == _versions(apply_scd2(_feed(spark, sum(rows, [])), ["k"], "seq", ["v"]))


def _delta(spark, h, number):
    return spark.read.parquet(f"{h.history_path}/batch_id={number}")


def test_late_row_of_a_long_key_writes_three_versions(spark, scratch):
    h = ChangeLogHistory(spark, scratch("long"), ["k"], "s", ["t"], buckets=2)
    base = spark.range(10_000).selectExpr("1L k", "id * 10 s", "concat('v', id) t", "id x")
    h.apply_batch(base, 0)
    h.apply_batch(base.selectExpr("k", "s + 1 s", "t", "x + 1 x"), 1)       # every version gets a second row
    late = spark.createDataFrame([(1, 50_000 + 0, "v5000", 7), (1, 30_004, "late", 1)], SCHEMA)
    h.apply_batch(late.where("s = 30004"), 2)
    # appended behind the version's last row: it ends earlier, and the new version is written
    got = sorted((r.s, r["__START_AT"], r["__END_AT"]) for r in _delta(spark, h, 2).collect())
    assert got == [(30_001, 30_000, 30_004), (30_004, 30_004, 30_010)]
    h.apply_batch(spark.createDataFrame([(1, 70_000, "zzz", 0)], SCHEMA), 3)  # ties with a first row, and wins
    h.apply_batch(spark.createDataFrame([(1, 40_000, "v3999", 9)], SCHEMA), 4)
    h.apply_batch(spark.createDataFrame([(1, -5, "first", 9)], SCHEMA), 5)
    assert [_delta(spark, h, n).count() for n in (3, 5)] == [2, 1]
    assert 4 not in h._committed(h.history_path)                              # the loser of a tie changes nothing
    everything = h._load(h.log_path, range(6)).select("k", "s", "t", "x")
    want = apply_scd2(everything, ["k"], "s", ["t"])
    assert h.history().exceptAll(want.select(h.history().columns)).count() == 0
    assert h.history().count() == want.count()


def test_late_row_inside_a_version_writes_three_versions(spark, scratch):
    h = ChangeLogHistory(spark, scratch("inside"), ["k"], "s", ["t"], buckets=2)
    base = spark.range(30_000).selectExpr("1L k", "id s", "concat('v', floor(id / 3)) t", "id x")  # 10,000 versions
    h.apply_batch(base.where("s != 15001"), 0)
    h.apply_batch(spark.createDataFrame([(1, 15_001, "late", 0)], SCHEMA), 1)
    got = sorted((r.t, r["__START_AT"], r["__END_AT"], r["scd_deleted"]) for r in _delta(spark, h, 1).collect())
    assert got == [("late", 15_001, 15_002, False), ("v5000", 15_000, 15_001, False), ("v5000", 15_002, 15_003, False)]
    # a row that joins two versions again leaves a tombstone
    h.apply_batch(spark.createDataFrame([(1, 15_001, "v5000", 0)], SCHEMA), 2)
    assert rows_of(h.history()) == rows_of(apply_scd2(h._load(h.log_path, range(3)).select("k", "s", "t", "x"),
                                                      ["k"], "s", ["t"]))
    assert _delta(spark, h, 2).where("scd_deleted").count() == 2


def test_recent_batch_reads_no_log_and_a_late_one_only_its_ranges(spark, scratch, monkeypatch):
    import datetime as dt
    schema = "k long, at timestamp_ntz, t string"
    day = lambda y, m: dt.datetime(y, m, 1)
    h = ChangeLogHistory(spark, scratch("ranges"), ["k"], "at", ["t"], buckets=2)
    rows = [(k, day(y, m), "AB"[(y + m // 4) % 2]) for k in range(4) for y in range(2015, 2022) for m in (1, 4, 9)]
    h.apply_batch(spark.createDataFrame(rows, schema), 0)
    read = []
    cut_log = ChangeLogHistory.cut_log

    def seen(self, *args):
        read.append(cut_log(self, *args))
        return read[-1]

    monkeypatch.setattr(ChangeLogHistory, "cut_log", seen)
    recent = [(1, day(2022, 1), "C"), (9, day(2022, 2), "D")]
    h.apply_batch(spark.createDataFrame(recent, schema), 1)
    assert read == []                                         # only appended: the log is not scanned
    late = [(2, dt.datetime(2018, 2, 1), "L"), (2, dt.datetime(2018, 6, 1), "L")]
    h.apply_batch(spark.createDataFrame(late, schema), 2)
    assert len(read) == 1
    plan = read[0]._jdf.queryExecution().executedPlan().toString()
    pruned = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "scd_bucket" in pruned and "scd_range" in pruned and pruned.count("2018") == 2  # other years are left out
    assert {r[0].year for r in read[0].select("at").distinct().collect()} == {2018}
    everything = spark.createDataFrame(rows + recent + late, schema)
    want = apply_scd2(everything, ["k"], "at", ["t"])
    assert sorted(map(str, h.history().collect())) == sorted(map(str, want.select(h.history().columns).collect()))


def test_rows_logged_by_a_run_that_was_given_up_are_applied(spark, scratch):
    h = ChangeLogHistory(spark, scratch("lost"), ["k"], "s", ["t"], buckets=2)
    h.apply_batch(spark.createDataFrame([(1, 1, "A", 0), (1, 9, "A", 0)], SCHEMA), 0, "a")
    lost = spark.createDataFrame([(1, 5, "B", 0), (2, 1, "Z", 0)], SCHEMA)
    h._write(lost, f"{h.log_path}/batch_id={h._commit_number('a', 1)}")       # logged, then lost for good
    h.apply_batch(spark.createDataFrame([(3, 1, "Q", 0)], SCHEMA), 0, "b")
    want = [(1, 1, "A", 0), (1, 9, "A", 0), (1, 5, "B", 0), (2, 1, "Z", 0), (3, 1, "Q", 0)]
    assert rows_of(h.history()) == rows_of(apply_scd2(spark.createDataFrame(want, SCHEMA), ["k"], "s", ["t"]))


def test_compaction_with_retention_keeps_files_of_open_readers(spark, scratch):
    h = ChangeLogHistory(spark, scratch("retain"), ["k"], "s", ["t"], buckets=2)
    for i in range(3):
        h.apply_batch(spark.createDataFrame([(k, i, "AB"[(i + k) % 2], i) for k in range(5)], SCHEMA), i)
    reader, want = h.history(), rows_of(h.history())
    h.compact_history(2, retention_s=3600)
    h.compact_log(2, retention_s=3600)
    assert rows_of(reader) == want == rows_of(h.history())     # listed before the compaction, read after it
    h.apply_batch(spark.createDataFrame([(0, 1, "Z", 9)], SCHEMA), 3)
    want = rows_of(h.history())
    h.vacuum()
    assert rows_of(h.history()) == want
    assert h._committed(h.history_path) == [-1, 3] and h._committed(h.log_path) == [-1, 3]


def test_a_large_batch_is_committed_whole_and_read_without_a_shuffle(spark, scratch):
    h = ChangeLogHistory(spark, scratch("whole"), ["k"], "s", ["t"], buckets=2)
    rows = [(k, s, "AB"[(s // 3 + (k or 0)) % 2], s) for k in [*range(20), None] for s in range(6)]
    for n in range(3):
        h.apply_batch(spark.createDataFrame([r for i, r in enumerate(rows) if i % 3 == n], SCHEMA), n)
    want = rows_of(apply_scd2(spark.createDataFrame(rows, SCHEMA), ["k"], "s", ["t"]))
    assert h._live() == [2] and rows_of(h.history()) == want
    assert "Exchange" not in h.history()._jdf.queryExecution().executedPlan().toString()
    h.apply_batch(spark.createDataFrame([(3, 9, "Z", 0)], SCHEMA), 3)          # a small one is spliced
    assert h._live() == [2, 3] and _delta(spark, h, 3).count() == 2
    want = rows_of(h.history())
    h.compact_history(2, retention_s=3600)                                      # what came before 2 stays unread
    assert h._live() == [-1, 2, 3] and rows_of(h.history()) == want
    h.vacuum()
    assert h._live() == [-1, 3] and rows_of(h.history()) == want
    h.compact_history(3)
    h.compact_log(3)
    assert h._live() == [-2] and rows_of(h.history()) == want
