"""A minimal acyclic automaton over words that numbers them, with their id sequences as outputs."""

from __future__ import annotations

import io

import numpy as np


def build(entries: dict[bytes, list[int]]) -> bytes:
    """The automaton of ``entries`` (word -> ids) as the bytes of one file.

    Words are added in sorted order; a state is frozen when no later word can pass it, and
    merged with an equal frozen state, so common suffixes are shared. Each arc carries how
    many words sort before those it leads to; the sum along a path is the word's number.
    """
    words = sorted(entries)
    register: dict[tuple, int] = {}
    final, arcs = [], []  # of frozen states
    # the path of the last word: [is final, [(label, frozen state)]]
    path: list[list] = [[False, []]]
    last = b""

    def freeze(state) -> int:
        key = (state[0], tuple(state[1]))
        n = register.get(key)
        if n is None:
            n = register[key] = len(final)
            final.append(state[0])
            arcs.append(state[1])
        return n

    for word in words:
        same = 0
        while same < len(last) and same < len(word) and last[same] == word[same]:
            same += 1
        while len(path) > same + 1:
            n = freeze(path.pop())
            path[-1][1].append((last[len(path) - 1], n))
        path.extend([False, []] for _ in word[same:])
        path[-1][0] = True
        last = word
    while len(path) > 1:
        n = freeze(path.pop())
        path[-1][1].append((last[len(path) - 1], n))
    root = freeze(path[0])

    below = [0] * len(final)
    key, target, skip = [], [], []
    for s in range(len(final)):  # children are frozen before their parents
        before = int(final[s])
        for label, t in arcs[s]:
            key.append(s * 256 + label)
            target.append(t)
            skip.append(before)
            before += below[t]
        below[s] = before
    ids = [entries[w] for w in words]
    out = io.BytesIO()
    arrays = [np.array([root], "<i8"), np.array(key, "<i8"), np.array(target, "<i8"), np.array(skip, "<i8"),
              np.array(final, "<i8"), np.cumsum([0] + [len(x) for x in ids]).astype("<i8"),
              np.array([i for x in ids for i in x], "<i8")]
    out.write(np.array([len(a) for a in arrays], "<i8").tobytes())
    for a in arrays:
        out.write(a.tobytes())
    return out.getvalue()


class Transducer:
    """A built automaton, memory-mapped; many words are walked at once."""

    def __init__(self, path: str):
        data = np.memmap(path, dtype="<i8", mode="r")
        sizes = data[:7].tolist()
        at, parts = 7, []
        for n in sizes:
            parts.append(data[at:at + n])
            at += n
        root, self._key, self._target, self._skip, self._final, self._start, self._ids = parts
        self._root = int(root[0])

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word in sorted order, -1 for words that are not there."""
        n = np.array([len(w) for w in words], dtype=np.int64)
        out = np.full(len(words), -1, dtype=np.int64)
        if not len(words) or not len(self._key):
            return out
        first = np.cumsum(n) - n
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        live = np.arange(len(words))
        state, number = np.full(len(words), self._root), np.zeros(len(words), dtype=np.int64)
        for k in range(int(n.max())):
            done = n[live] == k
            d = live[done]
            ok = d[self._final[state[d]] == 1]
            out[ok] = number[ok]
            live = live[~done]
            if not len(live):
                return out
            key = state[live] * 256 + data[first[live] + k]
            i = np.minimum(np.searchsorted(self._key, key), len(self._key) - 1)
            hit = self._key[i] == key
            live, i = live[hit], i[hit]
            number[live] += self._skip[i]
            state[live] = self._target[i]
        ok = live[self._final[state[live]] == 1]
        out[ok] = number[ok]
        return out

    def ids(self, number: int) -> list[int]:
        return self._ids[self._start[number]:self._start[number + 1]].tolist()
