"""Locally consistent parsing of word sequences by recompression rounds."""

from __future__ import annotations

import numpy as np

from tidemark.llm.common import mix64


class Level:
    """Symbols of one round: names, word extents, and the words each symbol depends on."""

    def __init__(self, name, start, end, lo, hi, doc):
        self.name, self.start, self.end, self.lo, self.hi, self.doc = name, start, end, lo, hi, doc


def _neighbours(lv: Level) -> tuple[np.ndarray, np.ndarray]:
    """lo of the left and hi of the right neighbour; at the ends of a document one word beyond it."""
    left = lv.start - 1
    right = lv.end + 1
    same = lv.doc[1:] == lv.doc[:-1]
    left[1:][same] = lv.lo[:-1][same]
    right[:-1][same] = lv.hi[1:][same]
    return left, right


def name_runs(lv: Level) -> Level:
    """Replace every maximal run of one symbol by a symbol named after (symbol, run length)."""
    n = len(lv.name)
    if n == 0:
        return lv
    new = np.ones(n, dtype=bool)
    new[1:] = (lv.name[1:] != lv.name[:-1]) | (lv.doc[1:] != lv.doc[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:] - 1, n - 1)
    left, right = _neighbours(lv)
    k = (last - first + 1).astype(np.uint64)
    name = np.where(k > 1, mix64(lv.name[first] + k * np.uint64(0x9FB21C651E98DF25)), lv.name[first])
    return Level(name, lv.start[first], lv.end[last], left[first], right[last], lv.doc[first])


def name_pairs(lv: Level, round_no: int) -> Level:
    """One pair round: a symbol's hash puts it left or right; left-right neighbours become one symbol.

    A pair depends on its two symbols alone; a symbol that stays single depends on the
    neighbour it might have joined.
    """
    n = len(lv.name)
    if n < 2:
        return lv
    side = (mix64(lv.name + np.uint64(round_no * 0x632BE59B + 1)) >> np.uint64(40)) & np.uint64(1) == 0
    same = lv.doc[1:] == lv.doc[:-1]
    pair = np.zeros(n, dtype=bool)
    pair[:-1] = side[:-1] & ~side[1:] & same
    second = np.zeros(n, dtype=bool)
    second[1:] = pair[:-1]
    left, right = _neighbours(lv)
    lo = np.where(side, lv.lo, left)
    hi = np.where(side, right, lv.hi)
    head = np.flatnonzero(~second)
    joined = pair[head]
    tail = head + joined
    name = lv.name[head].copy()
    j = head[joined]
    name[joined] = mix64(lv.name[j] * np.uint64(0xA24BAED4963EE407) + lv.name[j + 1] + np.uint64(round_no))
    lo = np.where(joined, lv.lo[head], lo[head])
    hi = np.where(joined, lv.hi[tail], hi[head])
    return Level(name, lv.start[head], lv.end[tail], lo, hi, lv.doc[head])


def anchors(words: np.ndarray, doc: np.ndarray, window: int, rounds: int):
    """The symbol that stands for each window of ``window`` words inside one document.

    Returns (window starts, anchor starts, anchor ends): the words whose content decides
    that the symbol is there. Of the symbols that a window holds with everything they
    depend on, the one of the highest round with the smallest name (then the leftmost)
    is taken, so equal windows take equal symbols at equal offsets. A window without
    such a symbol is its own anchor.
    """
    n = len(words)
    if n < window:
        z = np.zeros(0, dtype=np.int64)
        return z, z, z
    pos = np.arange(n, dtype=np.int64)
    p = np.flatnonzero(doc[:n - window + 1] == doc[window - 1:])
    a_lo, a_hi = p.copy(), p + window
    lv = name_runs(Level(words, pos, pos + 1, pos, pos + 1, doc))
    levels = []
    for r in range(rounds):
        lv = name_pairs(lv, r)
        levels.append(lv)
    w = np.arange(len(p))
    for lv in reversed(levels):
        # lo and hi ascend over the symbols, so a window's symbols are neighbours
        at = np.searchsorted(lv.lo, p[w], side="left")
        stop = np.searchsorted(lv.hi, p[w] + window, side="right")
        some = at < stop
        w_in, at, stop = w[some], at[some], stop[some]
        best = at.copy()
        for k in range(1, int((stop - at).max()) if len(at) else 0):
            cand = np.minimum(at + k, stop - 1)
            best = np.where(lv.name[cand] < lv.name[best], cand, best)
        a_lo[w_in], a_hi[w_in] = lv.lo[best], lv.hi[best]
        w = w[~some]
    return p, a_lo, a_hi
