import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.operators.scd2 import apply_scd2, count_null_sequences, find_hot_keys

SCHEMA = "k long, s long, t string, x long"


def nkey(v):
    """Sort key tolerating NULLs (NULL first)."""
    return tuple((x is not None, x) for x in v)


def versions(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    out = apply_scd2(df, ["k"], "s", ["t"], **kw)
    return sorted(((r.k, r.t, r.x, r["__START_AT"], r["__END_AT"], r["__CURRENT"]) for r in out.collect()), key=nkey)


CASES = [
    # (rows as (s, t[, x]), expected [(t, start, end)])
    ([(1, "A"), (2, "A"), (3, "A")], [("A", 1, None)]),
    ([(1, "A"), (2, "B"), (3, "A")], [("A", 1, 2), ("B", 2, 3), ("A", 3, None)]),
    ([(1, "A"), (4, "A"), (5, "A"), (3, "B")], [("A", 1, 3), ("B", 3, 4), ("A", 4, None)]),
    ([(1, "A"), (1, "A")], [("A", 1, None)]),
    ([(1, "A"), (1, "B")], [("B", 1, None)]),
    ([(1, None), (2, None), (3, "A")], [(None, 1, 3), ("A", 3, None)]),
]


@pytest.mark.parametrize("rows,expected", CASES)
def test_version_cases(spark, rows, expected):
    got = versions(spark, [(1, s, t, 0) for s, t in rows])
    assert [(t, a, b) for _, t, _, a, b, _ in sorted(got, key=lambda v: nkey(v[3:4]))] == expected


def test_untracked_column_shows_last_value(spark):
    got = versions(spark, [(1, 1, "A", 1), (1, 2, "A", 2)])
    assert got == [(1, "A", 2, 1, None, True)]


def test_null_sequence_dropped_and_counted(spark):
    df = spark.createDataFrame([(1, None, "A", 0), (1, 2, "A", 0), (2, None, "B", 0)], SCHEMA)
    out = apply_scd2(df, ["k"], "s", ["t"]).collect()
    assert [(r.k, r["__START_AT"]) for r in out] == [(1, 2)]
    assert count_null_sequences(df, "s").first()[0] == 2


def test_null_key_is_a_key(spark):
    got = versions(spark, [(None, 1, "A", 0), (None, 2, "B", 0)])
    assert [(k, t, a, b) for k, t, _, a, b, _ in got] == [(None, "A", 1, 2), (None, "B", 2, None)]


def _random_feed(seed, n_keys=5, n_rows=200):
    rnd = random.Random(seed)
    return [(rnd.randrange(n_keys), rnd.randrange(60), rnd.choice(["A", "B", None]),
             rnd.randrange(3)) for _ in range(n_rows)]


def _check_intervals(got):
    by_key = {}
    for k, t, x, a, b, cur in got:
        by_key.setdefault(k, []).append((a, b, cur))
    for k, vs in by_key.items():
        vs.sort(key=nkey)
        assert sum(1 for v in vs if v[2]) == 1, k          # one current row
        for (a1, b1, _), (a2, _, _) in zip(vs, vs[1:]):
            assert b1 == a2                                  # contiguous, disjoint
        assert vs[-1][1] is None and vs[-1][2]


def test_properties_order_and_duplicates(spark):
    rows = _random_feed(1)
    base = versions(spark, rows)
    _check_intervals(base)
    shuffled = rows + rows[:50]
    random.Random(2).shuffle(shuffled)
    assert versions(spark, shuffled) == base


def test_chunked_equals_unchunked(spark):
    rows = _random_feed(3, n_keys=3, n_rows=400)
    plain = versions(spark, rows, rows_per_chunk=0)
    chunked = versions(spark, rows, rows_per_chunk=7, sample_fraction=1.0)
    assert chunked == plain
    df = spark.createDataFrame(rows, SCHEMA)
    hot = find_hot_keys(df, ["k"], "s", rows_per_chunk=7, sample_fraction=1.0).collect()
    assert len(hot) == 3 and all(h["_rows"] >= 14 for h in hot)


def hot_keys(spark, *keys):
    return spark.createDataFrame([(k,) for k in keys], "k long")


def test_hot_key_with_explicit_ranges_and_late_rows(spark):
    # One key holds every row and is split in many ranges; changes sit on
    # range borders and some ranges hold no version start at all.
    rows = [(7, s, "A" if (s // 40) % 2 == 0 else "B", s) for s in range(400)]
    rows += [(7, 1000 + s, "B", s) for s in range(5)]
    plain = versions(spark, rows, rows_per_chunk=0)
    for nb in (2, 3, 16, 50):
        assert versions(spark, rows, hot_keys=hot_keys(spark, 7), ranges=nb) == plain, nb


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 30),
                          st.sampled_from(["A", "B", None]), st.integers(0, 2)),
                min_size=1, max_size=60),
       st.integers(2, 6))
def test_ranges_never_change_results(spark, rows, nb):
    plain = versions(spark, rows, rows_per_chunk=0)
    some = sorted({r[0] for r in rows})[:2]          # a third key, if any, stays cold
    assert versions(spark, rows, hot_keys=hot_keys(spark, *some), ranges=nb) == plain


def test_hot_null_key_and_string_sequence(spark):
    df = spark.createDataFrame([(None, f"{i:03d}", "AB"[i // 7 % 2], i) for i in range(60)] + [(1, "a", "A", 0)],
                               "k long, s string, t string, x long")
    plain = apply_scd2(df, ["k"], "s", ["t"], rows_per_chunk=0)
    split = apply_scd2(df, ["k"], "s", ["t"], rows_per_chunk=5, sample_fraction=1.0, ranges=4)
    assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))


def test_timestamp_sequence_and_multiple_tracked(spark):
    import datetime as dt
    t = lambda d: dt.datetime(2026, 1, d)
    df = spark.createDataFrame(
        [(1, t(1), "Initial", 2, 9.99), (1, t(2), "Initial", 2, 9.99),
         (1, t(3), "Shipped", 2, 9.99), (1, t(4), "Shipped", 3, 9.99)],
        "order_item_id long, updated_at timestamp_ntz, item_status string, quantity int, "
        "unit_price double")
    out = apply_scd2(df, ["order_item_id"], "updated_at", ["item_status", "quantity"],
                     rows_per_chunk=1, sample_fraction=1.0).orderBy("__START_AT").collect()
    assert [(r.item_status, r.quantity, r["__START_AT"].day,
             r["__END_AT"].day if r["__END_AT"] else None) for r in out] == \
        [("Initial", 2, 1, 3), ("Shipped", 2, 3, 4), ("Shipped", 3, 4, None)]


def test_except_columns_and_ignore_null_updates(spark):
    df = spark.createDataFrame([(1, 1, "A", 5)], SCHEMA)
    out = apply_scd2(df, ["k"], "s", ["t"], except_columns=["x"])
    assert "x" not in out.columns
    with pytest.raises(NotImplementedError):
        apply_scd2(df, ["k"], "s", ["t"], ignore_null_updates=True)
