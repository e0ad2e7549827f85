"""A prefix tree of globally ordered n-gram sets, and a join by its traversal.

Sets are sorted arrays of 64-bit keys in one global order, rare keys first.
The tree is path-compressed.  A traversal carries the overlap with the query
along shared paths and leaves a subtree once the overlap so far and all that
can still follow, in the query or below, cannot reach what similarity asks.
"""

from __future__ import annotations

import numpy as np

PIECE = 64


def needed(a: int, b: int, t: tuple[int, int]) -> int:
    """Smallest overlap of sets of a and b elements with t[1] * overlap >= t[0] * union."""
    return -(-t[0] * (a + b) // (t[0] + t[1]))


class Node:
    """seg: keys that all sets below share after those above; low, high: their
    smallest and largest size; rest: the most keys that follow the begin of
    seg; comp: the component of all sets below, or MIXED."""

    __slots__ = ("comp", "high", "ids", "kids", "low", "rest", "seg")

    def __init__(self, seg: np.ndarray, comp: int | None = None) -> None:
        self.seg, self.kids, self.ids, self.comp = seg, {}, [], comp
        self.low, self.high, self.rest = 1 << 60, 0, 0


#: Sets of several components below a node.
MIXED = object()


class Components:
    """Union and find over identifiers."""

    def __init__(self) -> None:
        self.above: dict[int, int] = {}

    def top(self, x: int) -> int:
        up = self.above
        while (y := up.setdefault(x, x)) != x:
            up[x] = x = up[y]
        return x

    def unite(self, a: int, b: int) -> None:
        a, b = self.top(a), self.top(b)
        self.above[max(a, b)] = min(a, b)


class Trie:
    """Sets with an identifier, a size (elements that no other set has
    included) and keys; each belongs to a component of `parts`."""

    def __init__(self, t: tuple[int, int], parts: Components | None = None) -> None:
        self.t, self.root, self.sizes, self.parts = t, Node(np.empty(0, np.uint64)), {}, parts or Components()

    def insert(self, ident: int, size: int, keys: np.ndarray) -> None:
        self.sizes[ident] = size
        node, at, comp = self.root, 0, self.parts.top(ident)
        while True:
            node.low, node.high = min(node.low, size), max(node.high, size)
            if node.comp is None:
                node.comp = comp
            elif node.comp is not MIXED and self.parts.top(node.comp) != comp:
                node.comp = MIXED
            at += len(node.seg)
            node.rest = max(node.rest, len(keys) - at + len(node.seg))
            if at == len(keys):
                node.ids.append(ident)
                return
            kid = node.kids.get(int(keys[at]))
            if kid is None:
                kid = node.kids[int(keys[at])] = Node(keys[at:], comp)
                kid.ids.append(ident)
                kid.low = kid.high = size
                kid.rest = len(keys) - at
                return
            n = min(len(kid.seg), len(keys) - at)
            differ = np.flatnonzero(kid.seg[:n] != keys[at : at + n])
            cut = int(differ[0]) if len(differ) else n
            if cut < len(kid.seg):
                top = Node(kid.seg[:cut], kid.comp)
                top.low, top.high, top.rest = kid.low, kid.high, kid.rest
                kid.seg, kid.rest = kid.seg[cut:], kid.rest - cut
                top.kids[int(kid.seg[0])] = kid
                node.kids[int(keys[at])] = top
                kid = top
            node = kid

    def find(self, size: int, keys: np.ndarray, known: set[int] | None = None) -> list[int]:
        """A similar set of each component that has one, but for those in
        `known`.  One traversal: overlaps are carried along shared paths, and
        what is below a node of one component that is known is left out."""
        done, out, top = set(known or ()), [], self.parts.top
        stack = [(self.root, 0, 0)]
        while stack:
            node, at, have = stack.pop()
            if node.comp is None or node.comp is not MIXED and top(node.comp) in done:
                continue
            # The least that any set below asks for: that of the smallest
            # one still long enough.
            floor = -(-self.t[0] * size // self.t[1])
            if node.high < floor:
                continue
            need = needed(size, max(node.low, floor), self.t)
            rest = node.rest
            for s in range(0, len(node.seg), PIECE):
                if have + min(len(keys) - at, rest) < need:
                    break
                piece = node.seg[s : s + PIECE]
                end = int(np.searchsorted(keys, piece[-1], "right"))
                if end > at:
                    part = keys[at:end]
                    pos = np.searchsorted(part, piece)
                    pos[pos == len(part)] = 0
                    have += int((part[pos] == piece).sum())
                    at = end
                rest -= len(piece)
            else:
                for ident in node.ids:
                    if self.sizes[ident] * self.t[1] >= self.t[0] * size and have >= needed(size, self.sizes[ident], self.t) and top(ident) not in done:
                        done.add(top(ident))
                        out.append(ident)
                if have + min(len(keys) - at, rest) >= need:
                    stack.extend((kid, at, have) for kid in node.kids.values())
        return out


Item = tuple[int, int, np.ndarray]


def links(sets: list[Item], t: tuple[int, int]) -> list[tuple[int, int]]:
    """Links that connect what similarity connects among the sets (id, size,
    keys): for each pair of similar sets there is a path of links.

    All sets share one tree, whose nodes know their component; a set asks it
    once for one similar set a component, so a group of near copies costs a
    traversal a set, not one a pair.
    """
    tree, out = Trie(t), []
    for ident, size, keys in sorted(sets, key=lambda s: (s[1], s[0])):
        for found in tree.find(size, keys):
            out.append((ident, found))
            tree.parts.unite(ident, found)
        tree.insert(ident, size, keys)
    return out


def ask(sets: list[Item], queries: list[Item], component: dict[int, int], t: tuple[int, int]) -> list[tuple[int, int]]:
    """Links from each query to some similar set of each other component."""
    parts = Components()
    for ident, comp in component.items():
        parts.unite(ident, comp)
    tree = Trie(t, parts)
    for s in sets:
        tree.insert(*s)
    return [(q[0], found) for q in queries for found in tree.find(q[1], q[2], {parts.top(q[0])})]


def stars(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Links as (vertex, smallest vertex of its component)."""
    parts = Components()
    for a, b in found:
        parts.unite(a, b)
    return [(x, parts.top(x)) for x in list(parts.above) if parts.top(x) != x]
