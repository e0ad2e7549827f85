"""Suffixes of a byte buffer sorted by hashes, in numpy.

Prefix polynomial hashes tell in one step whether two substrings are equal, so
a binary search finds the common extension of two suffixes in about log2(span)
steps and a comparison reads one more byte.  The sort is a bottom-up merge
sort of all groups at once: each element finds its rank in the sibling run by
binary search.  Equal neighbours are verified by their bytes.
"""

from __future__ import annotations

import numpy as np

from .hashing import powers, prefix


class Suffixes:
    """Suffixes of buf, compared by their first `span` bytes."""

    def __init__(self, raw: bytes, span: int) -> None:
        self.raw, self.span = raw, span
        self.buf = np.frombuffer(raw, np.uint8)
        self.p = prefix(self.buf)
        self.back = powers(len(self.buf) + 1)[1]

    def _same(self, x: np.ndarray, y: np.ndarray, n) -> np.ndarray:
        return (self.p[x + n] - self.p[x]) * self.back[x] == (self.p[y + n] - self.p[y]) * self.back[y]

    def extension(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Bytes that the suffixes x and y begin with alike, span at most."""
        low, high = np.zeros(len(x), np.int64), np.full(len(x), self.span, np.int64)
        whole = self._same(x, y, self.span)
        low[whole] = self.span
        todo = np.flatnonzero(~whole)
        high[todo] -= 1
        for _ in range(self.span.bit_length()):
            if not len(todo):
                break
            mid = (low[todo] + high[todo] + 1) >> 1
            same = self._same(x[todo], y[todo], mid)
            low[todo[same]] = mid[same]
            high[todo[~same]] = mid[~same] - 1
            todo = todo[low[todo] < high[todo]]
        return low

    def compare(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 for suffix x before, like or after suffix y."""
        n = self.extension(x, y)
        end = n == self.span
        at = np.where(end, 0, n)
        a, b = self.buf[x + at].astype(np.int16), self.buf[y + at].astype(np.int16)
        return np.where(end, 0, np.sign(a - b))

    def sort(self, start: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Order of the elements by group, then by suffix.  group must ascend."""
        n = len(start)
        order = np.arange(n)
        first = np.searchsorted(group, group, "left")
        size = np.searchsorted(group, group, "right") - first
        width, largest = 1, int(size.max(initial=0))
        while width < largest:
            act = np.flatnonzero(size > width)  # places, not elements
            place = act - first[act]
            run = place // width
            odd = (run & 1).astype(bool)
            low = np.where(odd, (run - 1) * width, np.minimum((run + 1) * width, size[act]))
            high = np.where(odd, run * width, np.minimum((run + 2) * width, size[act]))
            begin, x = low.copy(), start[order[act]]
            while True:
                todo = np.flatnonzero(low < high)
                if not len(todo):
                    break
                mid = (low[todo] + high[todo]) >> 1
                c = self.compare(start[order[first[act[todo]] + mid]], x[todo])
                right = (c < 0) | ((c == 0) & odd[todo])
                low[todo] = np.where(right, mid + 1, low[todo])
                high[todo] = np.where(right, high[todo], mid)
            new = first[act] + (run // 2) * 2 * width + (place - run * width) + (low - begin)
            moved = order.copy()
            moved[new] = order[act]
            order = moved
            width *= 2
        return order


def runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of runs in which all keys but the last are
    constant and the last goes up by one."""
    if not len(keys[0]):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    new = np.ones(len(keys[0]), bool)
    new[1:] = keys[-1][1:] != keys[-1][:-1] + 1
    for k in keys[:-1]:
        new[1:] |= k[1:] != k[:-1]
    first = np.flatnonzero(new)
    return first, np.r_[first[1:], len(new)] - 1


def twins(raw: bytes, offset: np.ndarray, group: np.ndarray, low: np.ndarray, high: np.ndarray, span: int) -> tuple[np.ndarray, ...]:
    """Of the windows of contexts in raw: which are repeated in their group.

    Context r begins at offset[r] and holds the windows of `span` bytes that
    begin high[r] to low[r] bytes before its anchor, the highest first.
    Windows of one group with equal distance are compared.  Result: (context,
    distance, twice, first) of every window, by context and distance; twice:
    another context of the group has it; first: no equal one stands before it
    in the sorted order.  group must ascend.
    """
    count = high - low + 1
    row = np.repeat(np.arange(len(offset)), count)
    step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    dist = high[row] - step
    key = group[row] * (int(high.max(initial=0)) + 1) + dist
    by = np.argsort(key, kind="stable")
    twice, first = np.zeros(len(row), bool), np.ones(len(row), bool)
    k = key[by]
    paired = np.zeros(len(k), bool)
    same = k[1:] == k[:-1]
    paired[1:] |= same
    paired[:-1] |= same
    at = by[paired]  # the windows that have something to be compared with
    if len(at):
        k, start = key[at], offset[row[at]] + high[row[at]] - dist[at]
        s = Suffixes(raw, span)
        order = s.sort(start, k)
        at, k, start = at[order], k[order], start[order]
        near = np.flatnonzero(k[1:] == k[:-1])
        near = near[s._same(start[near], start[near + 1], span)]
        # Verify by bytes: one comparison for each run of neighbouring windows.
        a, b, d = row[at[near]], row[at[near + 1]], dist[at[near]]
        order = np.lexsort((d, b, a))
        near, a, b, d = near[order], a[order], b[order], d[order]
        equal = np.zeros(len(at), bool)  # like the next in the order
        for f, e in zip(*(x.tolist() for x in runs(a, b, d)), strict=True):
            x, y = int(start[near[e]]), int(start[near[e] + 1])  # the farthest window begins first
            n = span + e - f
            if raw[x : x + n] == raw[y : y + n]:
                equal[near[f : e + 1]] = True
            else:  # a collision of hashes: window by window
                for i in near[f : e + 1].tolist():
                    equal[i] = raw[int(start[i]) : int(start[i]) + span] == raw[int(start[i + 1]) : int(start[i + 1]) + span]
        twice[at] = equal
        twice[at[1:]] |= equal[:-1]
        first[at[1:]] = ~equal[:-1]
    order = np.lexsort((dist, row))
    return row[order], dist[order], twice[order], first[order]
