"""Metric trees of the anchors hierarchy over the integer points of a block, and what they are for:
the nearest of some entries for all points, with whole balls decided at once.

A tree is built from the middle out: about sqrt(n) anchors take the points nearest to them, the
balls around these are merged in pairs from below, and anchors with many points are split the same
way. Every ball caches the number and the sum of its points.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

#: Points of a ball that is not split further.
LEAF = 32
#: What the bounds of floating point arithmetic may be off by, relatively and absolutely.
_LOOSE, _SLACK = 1 + 1e-9, 1e-6


@dataclass
class BallTree:
    """Balls as arrays, the root last; children are -1 in a leaf.

    A ball's points are those of `order` from `begin` to `end`.
    """

    order: np.ndarray
    left: np.ndarray
    right: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    radius: np.ndarray
    total: np.ndarray

    @property
    def centre(self) -> np.ndarray:
        return self.total / (self.end - self.begin)[:, None]


def _distances(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    apart = points - to
    return np.sqrt(np.einsum("ij,ij->i", apart, apart))


def anchors(points: np.ndarray, wanted: int) -> list[np.ndarray]:
    """The places of the points nearest to each of at most `wanted` anchors; copies stay together.

    Each new anchor is the point farthest from its own one. It can only take points that are more
    than half as far from their anchor as the two anchors are from each other.
    """
    places = [0]
    owner = np.zeros(len(points), np.int64)
    away = _distances(points, points[0])
    while len(places) < wanted:
        new = int(away.argmax())
        if away[new] == 0:
            break
        apart = _distances(points[places], points[new])
        maybe = np.flatnonzero(away * _LOOSE >= apart[owner] / 2)
        there = _distances(points[maybe], points[new])
        nearer = there < away[maybe]
        moved = maybe[nearer]
        owner[moved], away[moved] = len(places), there[nearer]
        places.append(new)
    by_owner = np.argsort(owner, kind="stable")
    edges = np.flatnonzero(np.diff(owner[by_owner])) + 1
    return np.split(by_owner, edges)


class _Builder:
    def __init__(self, points: np.ndarray) -> None:
        self.exact = points
        self.points = points.astype(np.float64)
        self.leaves: dict[int, np.ndarray] = {}
        self.left: list[int] = []
        self.right: list[int] = []
        self.size: list[int] = []
        self.centre: list[list[float]] = []
        self.radius: list[float] = []
        self.total: list[list[int]] = []

    def _add(self, left: int, right: int, size: int, total: list[int], centre: list[float], radius: float) -> int:
        self.left.append(left)
        self.right.append(right)
        self.size.append(size)
        self.total.append(total)
        self.centre.append(centre)
        self.radius.append(radius)
        return len(self.left) - 1

    def _leaf(self, own: np.ndarray) -> int:
        total = self.exact[own].sum(axis=0).tolist()
        centre = [t / len(own) for t in total]
        radius = math.sqrt(float(((self.points[own] - centre) ** 2).sum(axis=1).max()))
        ball = self._add(-1, -1, len(own), total, centre, radius)
        self.leaves[ball] = own
        return ball

    def _pair(self, a: int, b: int) -> int:
        """A ball around two, from what they cache."""
        size = self.size[a] + self.size[b]
        total = [x + y for x, y in zip(self.total[a], self.total[b])]
        centre = [t / size for t in total]
        radius = max(math.dist(self.centre[ball], centre) + self.radius[ball] for ball in (a, b))
        return self._add(a, b, size, total, centre, radius * _LOOSE)

    def build(self, own: np.ndarray) -> int:
        """The number of the ball of these points."""
        if len(own) <= LEAF:
            return self._leaf(own)
        parts = anchors(self.points[own], int(np.ceil(np.sqrt(len(own)))))
        if len(parts) == 1:
            return self._leaf(own)
        return self._merged([self.build(own[part]) for part in parts])

    def _merged(self, names: list[int]) -> int:
        """Balls merged in pairs, at each step those whose common ball is smallest."""
        centres = np.array([self.centre[b] for b in names])
        radii = np.array([self.radius[b] for b in names])
        common = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(axis=2)) + radii[:, None] + radii
        np.fill_diagonal(common, np.inf)
        for _ in range(len(names) - 1):
            a, b = divmod(int(common.argmin()), len(names))
            names[a] = last = self._pair(names[a], names[b])
            centres[a], radii[a] = self.centre[last], self.radius[last]
            common[b], common[:, b] = np.inf, np.inf
            row = _distances(centres, centres[a]) + (radii + radii[a])
            row[np.isinf(common[a])] = np.inf
            common[a], common[:, a] = row, row
        return last


def ball_tree(points: np.ndarray) -> BallTree:
    """The tree of some integer points, at least one."""
    builder = _Builder(points)
    root = builder.build(np.arange(len(points)))
    # the points of a ball are those of its left child, then those of its right one
    begin = np.zeros(root + 1, np.int64)
    order = np.empty(len(points), np.int64)
    for ball in range(root, -1, -1):
        left, right = builder.left[ball], builder.right[ball]
        if left >= 0:
            begin[left] = begin[ball]
            begin[right] = begin[ball] + builder.size[left]
        else:
            order[begin[ball] : begin[ball] + builder.size[ball]] = builder.leaves[ball]
    return BallTree(
        order, np.array(builder.left), np.array(builder.right), begin, begin + np.array(builder.size),
        np.array(builder.radius), np.array(builder.total),
    )


@dataclass
class Decided:
    """Which entry each point is nearest to, and how many points were decided in whole balls."""

    nearest: np.ndarray
    counts: np.ndarray
    totals: np.ndarray
    in_balls: int


def nearest_entries(points: np.ndarray, tree: BallTree, entries: np.ndarray) -> Decided:
    """For each point the entry at the least squared distance, the first of several; exact.

    A ball inherits the entries that its parent could not exclude. An entry goes when another is
    nearer for every point of the ball. A ball with one entry left is wholly its own: its cached
    sum and count go to it. Points of leaves with several are compared one by one.
    """
    size = len(entries)
    real = entries.astype(np.float64)
    spread = np.sqrt(((real[:, None] - real[None]) ** 2).sum(axis=2))
    # the later one of two equal entries never wins
    alive = np.zeros(size, bool)
    alive[np.unique(entries, axis=0, return_index=True)[1]] = True
    nearest = np.empty(len(points), np.int64)
    counts = np.zeros(size, np.int64)
    totals = np.zeros((size, points.shape[1]), np.int64)
    centre, count = tree.centre, tree.end - tree.begin
    balls, lists = np.array([len(tree.left) - 1]), alive[None]
    in_balls, open_points, open_lists = 0, [], []
    while len(balls):
        squares = ((centre[balls][:, None] - real) ** 2).sum(axis=2)
        squares[~lists] = np.inf
        best = squares.argmin(axis=1)
        least = squares[np.arange(len(balls)), best]
        reach = 2 * tree.radius[balls][:, None] * spread[best]
        within = squares - least[:, None] <= reach * _LOOSE + _SLACK * (1 + least[:, None])
        lists = lists & within
        lists[np.arange(len(balls)), best] = True
        owned = lists.sum(axis=1) == 1
        np.add.at(counts, best[owned], count[balls[owned]])
        np.add.at(totals, best[owned], tree.total[balls[owned]])
        own, sizes = _points_of(tree, balls[owned])
        nearest[own] = np.repeat(best[owned], sizes)
        in_balls += len(own)
        leaf = ~owned & (tree.left[balls] < 0)
        if leaf.any():
            own, sizes = _points_of(tree, balls[leaf])
            open_points.append(own)
            open_lists.append(np.repeat(lists[leaf], sizes, axis=0))
        inner = ~owned & ~leaf
        balls = np.concatenate([tree.left[balls[inner]], tree.right[balls[inner]]])
        lists = np.concatenate([lists[inner], lists[inner]])
    if open_points:
        left_over, their_lists = np.concatenate(open_points), np.concatenate(open_lists)
        for start in range(0, len(left_over), 8192):
            some = left_over[start : start + 8192]
            entry = _closest(points[some], entries, their_lists[start : start + 8192])
            nearest[some] = entry
            np.add.at(counts, entry, 1)
            np.add.at(totals, entry, points[some])
    return Decided(nearest, counts, totals, in_balls)


def _points_of(tree: BallTree, balls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The points of some balls one after the other, and the number of each ball's."""
    begin, sizes = tree.begin[balls], (tree.end - tree.begin)[balls]
    before = np.cumsum(sizes) - sizes
    return tree.order[np.repeat(begin - before, sizes) + np.arange(sizes.sum())], sizes


def _closest(points: np.ndarray, entries: np.ndarray, allowed: np.ndarray) -> np.ndarray:
    """Exact: floating point numbers hold the integers up to 2^53, beyond that 64-bit integers do."""
    largest = max(np.abs(points).max(initial=0), np.abs(entries).max(initial=0))
    exact = 4 * points.shape[1] * int(largest) ** 2 < 1 << 53
    kind = np.float64 if exact else np.int64
    p, e = points.astype(kind), entries.astype(kind)
    squares = (e**2).sum(axis=1) - 2 * (p @ e.T)
    squares[~allowed] = np.inf if exact else np.iinfo(np.int64).max
    return squares.argmin(axis=1)
