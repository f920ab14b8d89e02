"""A tree over sets for finding all similar pairs by a traversal of the tree with itself.

A leaf entry is a set with its size and a bitmap of its hashed elements. A node holds the bits of
all sets under it and the range of their sizes. For two nodes, the common bits, plus what
collisions within one bitmap can hide, bound the overlap of any set under one with any under the
other; if that is too small for sizes in their ranges, the pair of nodes is left out with all
pairs under it. What remains at the leaves is decided from the sets themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Children of a node, and sets of a leaf.
FAN_OUT = 8


class SignatureTree:
    """sets: sorted, distinct 64-bit hashes; label: sets known to be joined have the same.

    With `spanning`, links are only looked for between sets that are not yet joined, and pairs of
    nodes all of whose sets are joined are left out. `side` (0 or 1) restricts the pairs to those
    with one set of either.
    """

    def __init__(
        self,
        sets: list[np.ndarray],
        percent: int,
        label: np.ndarray | None = None,
        spanning: bool = True,
        side: np.ndarray | None = None,
    ) -> None:
        self.sets, self.percent, self.spanning, self.side = sets, percent, spanning, side
        n = len(sets)
        sizes = np.array([len(s) for s in sets], np.int64)
        least = np.array([s[0] if len(s) else 0 for s in sets], np.uint64)
        self.order = np.lexsort((sizes, least))
        self.parent = np.arange(n)
        if label is not None and spanning:
            _, first, inverse = np.unique(label, return_index=True, return_inverse=True)
            self.parent = first[inverse]
        typical = int(np.median(sizes)) if n else 1
        self.bits = min(1 << 16, max(256, 1 << (4 * typical - 1).bit_length()))
        maps = np.zeros((n, self.bits // 8), np.uint8)
        for i, s in enumerate(sets):
            row = np.zeros(self.bits, bool)
            row[s & np.uint64(self.bits - 1)] = True
            maps[i] = np.packbits(row)
        ordered = maps[self.order].view(np.uint64)
        own = sizes[self.order]
        hidden = own - np.bitwise_count(ordered).sum(1).astype(np.int64)
        #: By level from the sets up: bitmaps, least and largest size, largest count of hidden elements.
        self.levels = [(ordered, own, own, hidden)]
        while len(self.levels[-1][0]) > 1:
            maps, low, high, hidden = self.levels[-1]
            at = np.arange(0, len(maps), FAN_OUT)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(maps, at, axis=0),
                    np.minimum.reduceat(low, at),
                    np.maximum.reduceat(high, at),
                    np.maximum.reduceat(hidden, at),
                )
            )
        self.uniform = [np.zeros(len(level[0]), bool) for level in self.levels]
        if n:
            self.uniform[0][:] = True

    def _root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return int(i)

    def _children(self, level: int, node: int) -> range:
        return range(node * FAN_OUT, min((node + 1) * FAN_OUT, len(self.levels[level - 1][0])))

    def _first(self, level: int, node: int) -> int:
        return int(self.order[node * FAN_OUT**level])

    def _is_one(self, level: int, node: int) -> bool:
        """All sets under the node are joined."""
        if self.uniform[level][node]:
            return True
        root = self._root(self._first(level, node))
        for child in self._children(level, node):
            if not self._is_one(level - 1, child) or self._root(self._first(level - 1, child)) != root:
                return False
        self.uniform[level][node] = True
        return True

    def _possible(self, level: int, nodes: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Which pairs of nodes of a level may hold a link: a matrix."""
        maps, low, high, hidden = self.levels[level]
        common = np.bitwise_count(maps[nodes][:, None] & maps[others][None]).sum(2, dtype=np.int64)
        most = common + np.minimum(hidden[nodes][:, None], hidden[others][None])
        most = np.minimum(most, np.minimum(high[nodes][:, None], high[others][None]))
        sizes = low[nodes][:, None] + low[others][None]
        fits = (100 * high[nodes][:, None] >= self.percent * low[others][None]) & (
            100 * high[others][None] >= self.percent * low[nodes][:, None]
        )
        return fits & ((100 + self.percent) * most >= self.percent * sizes)

    def overlap(self, i: int, j: int) -> int:
        a, b = self.sets[i], self.sets[j]
        if len(a) > len(b):
            a, b = b, a
        at = np.searchsorted(b, a)
        at[at == len(b)] = len(b) - 1
        return int((b[at] == a).sum())

    def _linked(self, i: int, j: int) -> bool:
        both = self.overlap(i, j)
        return 100 * both >= self.percent * (len(self.sets[i]) + len(self.sets[j]) - both)

    def links(self) -> Iterator[tuple[int, int]]:
        """Linked pairs; with `spanning` only those that join what was apart."""
        if len(self.sets) > 1:
            top = len(self.levels) - 1
            yield from self._within(top, 0)

    def _within(self, level: int, node: int) -> Iterator[tuple[int, int]]:
        if level == 0:
            return
        children = np.array(self._children(level, node))
        if level > 1:
            for child in children:
                yield from self._within(level - 1, int(child))
        if self.spanning and self._is_one(level, node):
            return
        possible = self._possible(level - 1, children, children)
        for x, y in zip(*np.nonzero(np.triu(possible, 1))):
            yield from self._between(level - 1, int(children[x]), int(children[y]))

    def _between(self, level: int, a: int, b: int) -> Iterator[tuple[int, int]]:
        """Links between two nodes of a level, for which `_possible` holds."""
        if self.spanning and self._is_one(level, a) and self._is_one(level, b):
            if self._root(self._first(level, a)) == self._root(self._first(level, b)):
                return
        if level == 0:
            i, j = int(self.order[a]), int(self.order[b])
            if (self.side is None or self.side[i] != self.side[j]) and self._linked(i, j):
                if self.spanning:
                    self.parent[self._root(j)] = self._root(i)
                yield i, j
            return
        left, right = np.array(self._children(level, a)), np.array(self._children(level, b))
        for x, y in zip(*np.nonzero(self._possible(level - 1, left, right))):
            yield from self._between(level - 1, int(left[x]), int(right[y]))
