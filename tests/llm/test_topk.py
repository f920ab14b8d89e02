from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import topk
from sluice.llm.topk import Block, slices, top_k


def block(ids, ints) -> Block:
    row = {"n": len(ints), "dims": ints.shape[1], "ids": np.array(ids, "<i8").tobytes(), "ints": ints.astype("<i8").tobytes()}
    return Block(row | slices(ints))


@pytest.mark.parametrize("n,dims,most", [(1, 1, 3), (9, 2, 2), (200, 3, 1), (700, 16, 300), (130, 64, 10**6), (64, 4, 0)])
def test_block_against_brute_force(n, dims, most):
    rng = np.random.default_rng(n)
    ints = rng.integers(-most, most + 1, (n, dims))
    ids = rng.permutation(2 * n)[:n]
    index = block(ids, ints)
    for q in range(min(n, 25)):
        got, scores = index.top(int(ids[q]), ints[q], 10)
        all_scores = ints @ ints[q]
        order = [i for i in np.lexsort((ids, -all_scores)) if i != q][:10]
        assert got.tolist() == ids[order].tolist() and scores.tolist() == all_scores[order].tolist()


def test_sums_are_the_weighted_codes():
    rng = np.random.default_rng(1)
    ints = rng.integers(-500, 500, (300, 20))
    index = block(range(300), ints)
    weights = rng.integers(-90, 90, 20)
    codes = (ints - ints.min(0)) >> index.shift
    flipped = np.where(weights < 0, (1 << topk.CODE_BITS) - 1 - codes, codes)
    bits = [np.unpackbits(s.view(np.uint8), bitorder="little")[:300].astype(np.int64) for s in index.sums(weights)]
    assert (sum(b << p for p, b in enumerate(bits)) == flipped @ np.abs(weights)).all()


def model(rows: list[tuple], k: int) -> dict:
    usable = [
        (i, [math.floor(1024 * x) for x in v])
        for i, v, *_ in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = {}
    for place, (q, a) in enumerate(usable):
        if q % 3 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q)
            out.setdefault(q, []).append([(i, -s) for s, i in scored[:k]])
    return out


@pytest.mark.parametrize("rows_per_block", [3, 16_384])
def test_awkward_vectors(spark, monkeypatch, rows_per_block):
    monkeypatch.setattr(topk, "BLOCK_ROWS", rows_per_block)
    monkeypatch.setattr(topk, "QUERY_ROWS", 2)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=5).astype(np.float32).tolist(), "x") for i in range(30)]
    rows += [
        (30, None, None),
        (None, [1.0] * 5, None),
        (31, [1.0, None, 0.0, 0.0, 0.0], None),
        (32, [float("nan")] * 5, None),
        (33, [float("inf"), 0.0, 0.0, 0.0, 0.0], None),
        (36, [0.5, 0.25], None),
        (39, [], None),
        (42, [0.0] * 5, None),
        (43, [0.0] * 5, None),
        (45, rows[1][1], None),
        (46, rows[1][1], None),
        (46, rows[1][1], None),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string").repartition(3)
    got: dict = {}
    for r in top_k(table, F.col("vec_id") % 3 == 0, k=4).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = model(rows, 4)
    assert set(got) == set(want)
    for q, lists in want.items():
        assert got[q] == [(r + 1, i, s) for r, (i, s) in enumerate(lists[0])]
    few = top_k(table.filter("vec_id in (0, 1)"), F.col("vec_id") == 0, k=4).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in few] == [(0, 1, 1)]
    assert top_k(table.filter("false"), F.lit(True)).count() == 0
    assert top_k(table, F.lit(False)).count() == 0


def test_numbers_too_large_are_errors(spark):
    table = spark.createDataFrame([(0, [1e300]), (1, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        top_k(table, F.lit(True)).collect()
    table = spark.createDataFrame([(0, [1e9, 1e9]), (1, [1e9, 1e9])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64-bit"):
        top_k(table, F.lit(True)).collect()


def test_a_task_holds_few_queries_and_one_block(spark, monkeypatch):
    """Blocks meet in the tasks of a grid; they were joined, a row of both for each pair of them."""
    monkeypatch.setattr(topk, "BLOCK_ROWS", 3)
    monkeypatch.setattr(topk, "QUERY_ROWS", 2)
    into: list = []
    in_arrow = type(spark.range(0)).mapInArrow

    def noted(self, *args, **options):
        into.append(self)
        return in_arrow(self, *args, **options)

    rng = np.random.default_rng(6)
    rows = [(i % 41, rng.normal(size=4).tolist()) for i in range(45)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
    monkeypatch.setattr(type(table), "mapInArrow", noted)
    for part_bytes in (64 << 20, 2_000, 1):
        monkeypatch.setattr(topk, "PART_BYTES", part_bytes, raising=False)
        into.clear()
        got: dict = {}
        for r in top_k(table, F.col("vec_id") % 3 == 0, k=4).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        want = model(rows, 4)
        assert set(got) == set(want)
        for q, lists in want.items():
            assert sorted(got[q]) == sorted(pair for one in lists for pair in one)
        (searched,) = [df for df in into if "slices" in df.columns]
        asks = searched.filter("slices is null").select("block").distinct().count()
        blocks = searched.filter("slices is not null")
        copies = [r["count"] for r in blocks.groupBy("block").count().collect()]
        most = {64 << 20: 1, 2_000: 6, 1: asks}[part_bytes]
        assert asks >= 8 and len(copies) >= 15 and max(copies) <= most
        assert blocks.filter("octet_length(ints) != 2 * n * dims").isEmpty()


def test_blocks_of_long_vectors_are_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_BYTES", 8_000, raising=False)
    sizes = [2, 1, 3, 100, 2, 5_000, 4, 100, 100] + [100] * 30
    rows = [(i, [float(i)] * n) for i, n in enumerate(sizes)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1)
    blocks = topk.index_vectors(table).select("n", "dims", "ids").collect()
    assert all(b.n == 1 or 8 * b.n * b.dims <= 8_000 for b in blocks) and len(blocks) < 10
    assert [i for b in blocks for i in np.frombuffer(b.ids, "<i8").tolist()] == list(range(len(rows)))


def test_rows_below_the_best_so_far_may_stay_away():
    rng = np.random.default_rng(8)
    ints = rng.integers(-600, 600, (500, 9))
    index = block(range(500), ints)
    for q in range(40):
        scores = ints @ ints[q]
        order = [i for i in np.lexsort((np.arange(500), -scores)) if i != q][:10]
        for least in (scores[order[0]] + 1, scores[order[0]], scores[order[4]], scores[order[9]], -(10**9)):
            ids, found = index.top(q, ints[q], 10, int(least))
            there = found >= least
            wanted = [i for i in order if scores[i] >= least]
            assert ids[there].tolist() == wanted and found[there].tolist() == scores[wanted].tolist()
