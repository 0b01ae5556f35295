"""Spark-free parts of the corpus operators against brute force and round trips."""

import base64
import itertools
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import op2_linededup as L
from ledgerline.llm import op4_packing as K
from ledgerline.llm import op6_quality as Q
from ledgerline.llm import op7_bpe as B
from ledgerline.llm import op8_toxicity as X
from ledgerline.llm import op10_sharding as S
from ledgerline.llm import simple8b
from ledgerline.llm.common import hash_spans, lower_ascii, shingles, text_buffer, token_spans, word_spans
from ledgerline.llm.tokens import WordCacheEncoder

TEXTS = ["", " ", "a  b", "it's I'll 'r e\n'll x", "héllo\nworld's 12 3!!  ", "x\x85y z", "  x  y",
         "a" * 3000, "  " * 900 + "x", "ab'\n 're" * 200, " \n\n \t x1 2'll" * 150, "日本 語 а б c", "<|endoftext|> a"]
pieces = st.lists(st.sampled_from([" ", "\n", "  ", "\t", "a", "Be", "'s", "12", "!", "é", "_", "\r", "ß.", "日"]), max_size=60)


def _peak(function, *args):
    """(result, most bytes allocated at once meanwhile)."""
    tracemalloc.start()
    try:
        return function(*args), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_tokens_of_spaced_scripts_take_no_work_per_byte():
    """A text without characters of unspaced scripts makes no array of numbers as long as its bytes."""
    words = ["some\xe9", "words", "\u20ac", "\u0e01x", "more"]
    for picked, whole in (([0, 1, 2, 4], False), ([0, 1, 2, 3, 4], True)):
        column = pa.array([" ".join(words[i] for i in picked) + " "] + ["long" * 8 + " "] * 20000)
        data, offsets = text_buffer(column)
        (starts, ends, counts), bytes_held = _peak(token_spans, data, offsets)
        assert counts[0] == (6 if whole else 4) and (counts[1:] == 1).all()
        assert (bytes_held > 8 * len(data)) == whole
        _, bytes_held = _peak(hash_spans, data, starts, ends)
        assert bytes_held < 4 * len(data)


def test_hashes_of_words_do_not_depend_on_their_place():
    words = ["a", "bc" * 9000, "d" * 40000, "e", "f" * 32768, "g" * 32767]
    once = []
    for w in words:
        data, _ = text_buffer(pa.array([w]))
        once += hash_spans(data, np.array([0]), np.array([len(data)])).tolist()
    data, offsets = text_buffer(pa.array([" ".join(words * 5)]))
    starts, ends, _ = token_spans(data, offsets)
    assert hash_spans(data, starts, ends).tolist() == once * 5 and len(set(once)) == len(words)


@given(st.lists(st.integers(0, 30) | st.integers(0, 2**64 - 1), max_size=40),
       st.lists(st.integers(0, 30) | st.integers(0, 2**64 - 1), max_size=40))
@settings(max_examples=60, deadline=None)
def test_hashes_among_others(x, of):
    of += [v ^ (1 << 40) for v in x[::2]]  # equal low bits
    assert L.among(np.array(x, np.uint64), np.array(of, np.uint64)).tolist() == [v in of for v in x]


@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 60000) | st.just(0), max_size=900))
@settings(max_examples=60, deadline=None)
def test_simple8b_round_trip(values):
    v = np.array(values, np.uint64)
    words, frames, escapes = simple8b.encode(v)
    assert (simple8b.decode(words, escapes) == v).all()
    assert frames.sum() == len(words)


def test_simple8b_frames_decode_alone():
    v = np.arange(2000, dtype=np.uint64) % 777
    words, frames, _ = simple8b.encode(v)
    edges = np.concatenate([[0], np.cumsum(frames)])
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        assert (simple8b.decode(words[a:b], []) == v[i * 256:(i + 1) * 256]).all()


@pytest.fixture(scope="module")
def bpe():
    return B.load(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)


@pytest.mark.parametrize("leaf", [1, 7, 64])
def test_tree_encoding_equals_the_library(bpe, leaf):
    for text in TEXTS:
        ids = B.encode_tree(bpe.encode_ordinary, text, leaf)
        assert ids == bpe.encode_ordinary(text)
        assert B.decode_tree(bpe.decode_bytes, ids, leaf) == text.encode()


@given(pieces)
@settings(max_examples=200, deadline=None)
def test_tree_encoding_property(bpe, parts):
    text = "".join(parts)
    assert B.encode_tree(bpe.encode_ordinary, text, 3) == bpe.encode_ordinary(text)


@given(st.lists(pieces, max_size=4))
@settings(max_examples=100, deadline=None)
def test_word_cache_equals_the_library(cached, docs):
    texts = ["".join(p) for p in docs] + TEXTS
    whole = cached.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert cached.encode(texts) == [np.array(e.ids, "<u4").tobytes() for e in whole]


@pytest.fixture(scope="module")
def cached():
    return WordCacheEncoder(P.path("byte_bpe_50k.json"))


def test_rank_file_matches_ids():
    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    assert len(ranks) == 50256


@given(st.lists(st.lists(st.sampled_from(["A", "a", " ", "\t", "\n", "b", "é", " ", "\x0b"]), max_size=30), min_size=1, max_size=6))
@settings(max_examples=150, deadline=None)
def test_words_and_shingles_equal_plain_python(docs):
    texts = ["".join(d) for d in docs]
    data, offsets = text_buffer(pa.array(texts))
    data = lower_ascii(data)
    starts, ends, counts = word_spans(data, offsets)
    words = [t.encode().lower().split() for t in texts]
    assert counts.tolist() == [len(w) for w in words]
    flat = list(itertools.chain(*words))
    hashes = hash_spans(data, starts, ends)
    assert [bytes(data[a:b]) for a, b in zip(starts, ends)] == flat
    for i, j in itertools.combinations(range(len(flat)), 2):
        assert (hashes[i] == hashes[j]) == (flat[i] == flat[j])
    found, per = shingles(hashes, counts, 3)
    plain = [[tuple(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else ([tuple(w)] if w else []) for w in words]
    assert per.tolist() == [len(s) for s in plain]
    known = {}
    for h, s in zip(found.tolist(), itertools.chain(*plain)):
        assert known.setdefault(h, s) == s
    assert len(set(found.tolist())) == len(set(itertools.chain(*plain)))


def _plain_counts(x):
    x = x or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", x)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    covered = {j for i, t in enumerate(windows) if windows.count(t) > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in x.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x)), dup, len(covered)


@given(st.lists(st.none() | st.lists(st.sampled_from(["a", "b ", " ", "\n", "é", "#", "|x", "\r", "b a b a "]), max_size=40).map("".join), min_size=1, max_size=5))
@settings(max_examples=150, deadline=None)
def test_base_counts_equal_plain_python(texts):
    got = Q.base_counts(pa.array(texts, pa.string()))
    rows = list(zip(*(got[k].tolist() for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))))
    assert rows == [_plain_counts(t) for t in texts]


@given(st.lists(st.sampled_from("abcdef"), max_size=12), st.lists(st.sampled_from("abcdef"), max_size=12))
@settings(max_examples=200, deadline=None)
def test_patience_alignment_is_common_and_rising(a, b):
    pairs = L.patience(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:]))


@given(st.lists(st.lists(st.sampled_from(["a ", "b ", "c\n", "d ", "\n", "漢"]), max_size=30).map("".join), max_size=5))
@settings(max_examples=200, deadline=None)
def test_a_text_is_cut_alike_in_any_batch(texts):
    starts, ends, value, size, _, per = L.stretches(pa.array(texts, pa.string()))
    alone = [L.stretches(pa.array([t])) for t in texts]
    assert per.tolist() == [len(x[2]) for x in alone]
    assert value.tolist() == [v for x in alone for v in x[2].tolist()]
    assert size.tolist() == [v for x in alone for v in x[3].tolist()]


def _doomed(a, b, spans):
    at_a, at_b = [i for i, x in enumerate(a) if x in b], [j for j, x in enumerate(b) if x in a]
    return L.doomed_stretches([a[i] for i in at_a], [b[j] for j in at_b], spans, at_a, at_b)


def test_blocks_need_an_anchor():
    assert _doomed("xabcy", "zabcw", [(2, 2)]) == [1, 2, 3]
    assert _doomed("xabcy", "zabcw", []) == []
    assert _doomed("abcd", "dab", [(0, 0), (1, 1)]) == [0, 1, 2]
    assert _doomed("abxcd", "abycd", [(0, 0)]) == [0, 1]  # a block ends where the texts differ


@given(st.lists(st.lists(st.integers(0, 9), max_size=14), max_size=5))
@settings(max_examples=200, deadline=None)
def test_least_run_of_every_window_is_looked_up(texts):
    """Of any WINDOW neighbouring runs of a text (all, if fewer) the least is kept, and no other."""
    per = np.array([len(t) + 1 for t in texts], np.int64)
    begin = np.cumsum(per) - per
    first = np.array([b + i for b, t in zip(begin.tolist(), texts) for i in range(len(t))], np.int64)
    flat = np.array([h for t in texts for h in t], np.uint64)
    got = L.looked_up(first, flat, len(flat), per).tolist() if texts else []
    want = []
    for t in texts:
        kept = set()
        for i in range(max(1, len(t) - L.WINDOW + 1)):
            part = t[i:i + L.WINDOW]
            kept |= {i + d for d, h in enumerate(part) if h == min(part)}
        want += [i in kept for i in range(len(t))]
    assert got == want


def _plain_maximal(scores):
    """All maximal scoring segments by the recursive definition."""
    best, where = 0.0, None
    for i in range(len(scores)):
        for j in range(i + 1, len(scores) + 1):
            s = sum(scores[i:j])
            if s > best + 1e-9:
                best, where = s, (i, j)
    if where is None:
        return []
    i, j = where
    right = [(a + j, b + j, s) for a, b, s in _plain_maximal(scores[j:])]
    return _plain_maximal(scores[:i]) + [(i, j - 1, best)] + right


@given(st.lists(st.integers(0, 4), max_size=12))
@settings(max_examples=200, deadline=None)
def test_maximal_segments_equal_the_definition(marks):
    value = [{0: -X.PENALTY, 1: -X.PENALTY, 2: -X.PENALTY, 3: 0.11, 4: 0.07}[m] for m in marks]
    at = np.array([i for i, m in enumerate(marks) if m > 2], int)
    got = X.maximal_segments(at, np.array([value[i] for i in at]))
    want = _plain_maximal(value)
    assert sum(s for *_, s in got) == pytest.approx(sum(s for *_, s in want))


@pytest.mark.parametrize("gap", [1, 9, 50])
def test_maximal_segments_are_found_in_linear_time(gap):
    import time
    took = []
    for n in (40_000, 400_000):
        at = np.arange(0, n, gap)
        value = np.where(np.arange(len(at)) % 3 == 0, 0.11, 0.07)
        begin = time.process_time()
        got = X.maximal_segments(at, value)
        took.append(time.process_time() - begin)
        assert sum(b - a + 1 for a, b, _ in got) <= n
    assert took[1] < 40 * took[0] + 0.5  # a quadratic scan takes a hundred times as long, or 16 s


@given(st.lists(st.integers(0, 40), min_size=64, max_size=64), st.integers(0, 5000))
@settings(max_examples=40, deadline=None)
def test_plan_places_every_remainder_once(counts, copies):
    histogram = np.array(counts, np.int64)
    histogram[17] += copies
    histogram[0] = 3
    plan = K.Plan(histogram, 64)
    used = {}
    for length in range(1, 64):
        for rank in range(histogram[length]):
            done = 0
            for start, size, sequence, offset in plan.place(length, rank):
                assert start == done
                done += size
                used.setdefault(sequence, []).append((offset, size))
            assert done == length
    for held in used.values():
        held.sort()
        assert held[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(held, held[1:]))
        total = sum(n for _, n in held)
        assert total == 64 or total & (total - 1) == 0


def test_large_records_are_dealt_to_the_emptiest_shard():
    where, room = S.deal_large([90, 50, 40], 400, 4)
    assert where == [0, 1, 2]
    assert (room + np.bincount(where, [90, 50, 40], 4)).tolist() == [100, 100, 100, 100]
