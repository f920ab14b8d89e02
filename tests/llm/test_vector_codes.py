"""Codes of vectors, and the trees that find them, against comparing all entries."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

from sluice.llm import metric_tree
from sluice.llm.metric_tree import anchors, ball_tree, nearest_entries
from sluice.llm.vector_codes import compress

VECTORS = "vec_id long, embedding array<float>, label int, n long, `a.b` string"


def clouds(rng, n, width, spread=4, size=300):
    centres = rng.integers(-size, size, (12, width))
    return centres[rng.integers(0, 12, n)] + rng.integers(-spread, spread + 1, (n, width))


def closest(points, entries):
    return ((points[:, None] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)


@pytest.mark.parametrize("width", [1, 4, 9])
def test_a_ball_holds_its_points_and_caches_their_sum(width):
    points = clouds(np.random.default_rng(0), 3000, width)
    tree = ball_tree(points)
    assert sorted(tree.order.tolist()) == list(range(3000)) and tree.end[-1] - tree.begin[-1] == 3000
    for ball in range(len(tree.left)):
        own = points[tree.order[tree.begin[ball] : tree.end[ball]]]
        assert (own.sum(axis=0) == tree.total[ball]).all()
        away = np.sqrt(((own - tree.centre[ball]) ** 2).sum(axis=1))
        assert away.max() <= tree.radius[ball] * (1 + 1e-9) + 1e-9


def test_anchors_own_the_points_nearest_to_them():
    points = clouds(np.random.default_rng(1), 800, 3).astype(float)
    parts = anchors(points, 20)
    assert sorted(np.concatenate(parts).tolist()) == list(range(800)) and 2 <= len(parts) <= 20
    assert [len(p) for p in anchors(np.ones((50, 2)), 7)] == [50]


@pytest.mark.parametrize("seed", range(6))
def test_nearest_entries_are_exact(seed):
    """Also with equal entries, ties, copies and far points."""
    rng = np.random.default_rng(seed)
    points = [clouds(rng, 2500, 4), rng.integers(-3, 4, (2500, 2)), np.repeat(rng.integers(0, 9, (5, 3)), 300, axis=0),
              rng.integers(-(2**25), 2**25, (1500, 4)), rng.integers(-145, 145, (2500, 4)), np.zeros((200, 1), int)][seed]
    entries = np.concatenate([points[:40], points[:8], points[:16] + 1])
    found = nearest_entries(points, ball_tree(points), entries)
    want = closest(points, entries)
    assert (found.nearest == want).all()
    assert (found.counts == np.bincount(want, minlength=len(entries))).all()
    for e in range(len(entries)):
        assert (found.totals[e] == points[want == e].sum(axis=0)).all()


def test_whole_balls_are_decided_where_points_lie_in_clouds():
    points = clouds(np.random.default_rng(2), 8000, 4)
    found = nearest_entries(points, ball_tree(points), points[:64])
    apart = np.unique(points[:64] // 40, axis=0)
    assert len(apart) > 5 and found.in_balls > 0
    one_each = np.unique(clouds(np.random.default_rng(2), 8000, 4, spread=0), axis=0)
    assert nearest_entries(points, ball_tree(points), one_each).in_balls > 7000


def plain(rows, parts, entries, rounds, scale):
    usable = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    usable.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    points = np.floor(scale * np.array([np.float32(r[1]) for r in usable], float)).astype(np.int64)
    cut = np.split(points, parts, axis=1)
    books = [part[:entries].copy() for part in cut]
    for _ in range(rounds):
        for part, book in zip(cut, books):
            own = closest(part, book)
            for e in set(own.tolist()):
                mine = part[own == e]
                book[e] = [int(s) // len(mine) for s in mine.sum(axis=0)]
    codes = np.stack([closest(part, book) for part, book in zip(cut, books)], axis=1)
    errors = sum(((part - book[codes[:, p]]) ** 2).sum(axis=1) for p, (part, book) in enumerate(zip(cut, books)))
    by_label: dict = {}
    for r, e in zip(usable, errors.tolist()):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    out = [(r[0], tuple(c), e, by_label[r[2]]) for r, c, e in zip(usable, codes.tolist(), errors.tolist())]
    text = ",".join(str(x) for book in books for x in book.ravel().tolist())
    return sorted(out, key=repr), hashlib.sha256(text.encode()).hexdigest()


def table(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 7, "x") for r in rows], VECTORS).repartition(parts)


@pytest.mark.parametrize("n,entries,rounds", [(900, 64, 2), (20, 64, 1), (300, 5, 3), (300, 5, 0)])
def test_against_plain_loops(spark, n, entries, rounds):
    rng = np.random.default_rng(n)
    rows = [(int(i), np.float32(v).tolist(), int(i) % 3 or None) for i, v in enumerate(rng.normal(0, 0.4, (n, 8)))]
    rows = [*rows[::-1], rows[3], rows[3], (None, rows[4][1], 1), (None, rows[5][1], None)]
    rows += [(-1, None, 1), (-2, [None] * 8, 1), (-3, [float("nan")] * 8, 1), (-4, [1.0] * 7 + [float("-inf")], 1)]
    found, books = compress(table(spark, rows), parts=4, entries=entries, rounds=rounds, scale=64)
    assert found.columns == ["vec_id", "label", "code", "error", "label_error"]
    got = sorted(((r.vec_id, tuple(r.code), r.error, r.label_error) for r in found.collect()), key=repr)
    assert (got, books.sha256()) == plain(rows, 4, entries, rounds, 64)


def test_codes_stand_for_vectors_at_their_error(spark):
    rng = np.random.default_rng(8)
    rows = [(i, v.tolist(), None) for i, v in enumerate(rng.normal(0, 0.3, (400, 8)).astype(np.float32))]
    found, books = compress(table(spark, rows), parts=2, entries=16)
    for r in found.collect():
        vector = np.floor(256 * np.array(rows[r.vec_id][1]))
        assert r.error == ((vector - books.decoded(np.array([r.code]))[0]) ** 2).sum()


def test_blocks_do_not_change_the_result(spark):
    rng = np.random.default_rng(9)
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(rng.normal(0, 0.3, (700, 8)).astype(np.float32))]
    results = []
    for parts in (1, 7):
        found, books = compress(table(spark, rows, parts), parts=4, entries=10)
        results.append((sorted(map(repr, found.collect())), books.sha256()))
    assert results[0] == results[1]


def test_empty_tables_and_vectors_that_do_not_fit(spark):
    for rows in ([], [(1, None, 1)]):
        found, books = compress(table(spark, rows), parts=4)
        assert found.collect() == [] and books.entries.size == 0
        assert found.columns == ["vec_id", "label", "code", "error", "label_error"]
    for rows in ([(1, [0.5] * 6, 1)], [(1, [0.5] * 8, 1), (2, [0.5] * 4, 1)], [(1, [1e30] * 8, 1)], [(1, [], 1)]):
        with pytest.raises(Exception, match="components|too large"):
            compress(table(spark, rows), parts=4)[0].collect()


def test_trees_of_few_points():
    for n in (1, 2, metric_tree.LEAF, metric_tree.LEAF + 1):
        points = np.arange(2 * n).reshape(n, 2)
        assert (nearest_entries(points, ball_tree(points), points[:1]).nearest == 0).all()
