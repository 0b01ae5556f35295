"""Simple-8b word-aligned coding of unsigned integers, encoded and decoded with numpy.

A 64-bit word holds a 4-bit selector (top bits) and up to 60 values of equal
width.  Values are coded in frames of ``FRAME``; a frame starts at a word
boundary, so a table of words per frame lets any frame be decoded alone.  A
value too wide for a word is an escape: its word holds selector 15 and the raw
value is appended to the escape list.
"""

from __future__ import annotations

import numpy as np

#: Fixed values of the code: (values per word, bits per value) by selector.
LAYOUT = ((240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6),
          (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
ESCAPE = 15
FRAME = 256

_COUNT = np.array([n for n, _ in LAYOUT])
_RANK = {b: i for i, b in enumerate(sorted({b for _, b in LAYOUT[:-1]}))}  # widths in order


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, words per frame, escapes).

    Selectors 0 and 1 stand for 240 and 120 zeros.  Selector 15 holds one value
    of up to 60 bits, or, with all payload bits set, points to the next escape.
    """
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    frames = -(-n // FRAME)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    full = (1 << 60) - 1
    wide = values >= np.uint64(full)
    escapes = values[wide]
    plain = np.where(wide, np.uint64(full), values)
    width = np.zeros(n + 240, np.uint8)  # bits of each value; nothing after the last
    for bits in sorted({b for _, b in LAYOUT[:-1]}):
        width[:n] += plain >> np.uint64(bits) != 0
    at = np.arange(n)
    left = np.minimum(n, (at // FRAME + 1) * FRAME) - at  # values up to the end of the frame
    choice = np.full(n, ESCAPE, np.uint8)
    widest, size = width, 1  # of the next ``size`` values
    for sel in range(ESCAPE - 1, -1, -1):
        count, bits = LAYOUT[sel]
        widest = np.maximum(widest[:len(widest) - (count - size)], widest[count - size:])
        size = count
        choice[(widest[:n] <= _RANK[bits]) & (left >= count)] = sel
    step = _COUNT[choice]
    # all frames advance in step, one word each
    pos = np.arange(frames) * FRAME
    end = np.minimum(pos + FRAME, n)
    starts, owner, live = [], [], np.arange(frames)
    while len(live):
        starts.append(pos[live])
        owner.append(live)
        pos[live] += step[pos[live]]
        live = live[pos[live] < end[live]]
    starts, owner = np.concatenate(starts), np.concatenate(owner)
    starts = np.sort(starts)  # frames are ranges, so this is frame order too
    sel = choice[starts]
    words = sel.astype(np.uint64) << np.uint64(60)
    for s in np.unique(sel):
        count, bits = LAYOUT[s]
        if bits:
            rows = np.flatnonzero(sel == s)
            for j in range(count):
                words[rows] |= plain[starts[rows] + j] << np.uint64(bits * j)
    return words, np.bincount(owner, minlength=frames), escapes


def decode(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """All values of any run of whole frames."""
    words = np.asarray(words, np.uint64)
    sel = (words >> np.uint64(60)).astype(np.int64)
    count = _COUNT[sel]
    first = np.concatenate([[0], np.cumsum(count)])
    out = np.zeros(int(first[-1]), np.uint64)
    for s in np.unique(sel):
        n, bits = LAYOUT[s]
        if bits:
            rows = np.flatnonzero(sel == s)
            mask = np.uint64((1 << bits) - 1)
            for j in range(n):
                out[first[rows] + j] = (words[rows] >> np.uint64(bits * j)) & mask
    lone = np.flatnonzero(sel == ESCAPE)
    full = np.uint64((1 << 60) - 1)
    lone = first[lone][out[first[lone]] == full]
    out[lone] = np.asarray(escapes, np.uint64)[:len(lone)]
    return out
