from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from sluice.llm import common, hashing, similarity
from sluice.llm import components as connected
from sluice.llm.components import components
from sluice.llm.signature_tree import SignatureTree
from sluice.llm.similarity import one_of_each, similar_components, similar_pairs

from .cases import awkward, awkward_rows, families, groups, linked, nothing, shingles


def expected(rows: list[tuple]) -> Counter:
    sets = [shingles(text) for _, text, *_ in rows]
    root = groups(sets)
    ids: dict[int, list] = {}
    for r, (doc, *_) in zip(root, rows):
        if doc is not None:
            ids.setdefault(r, []).append(doc)
    return Counter(
        (doc, len(s), min(ids.get(r, [None])) if s else doc) for r, s, (doc, *_) in zip(root, sets, rows)
    )


def small(monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_ROWS", 3)
    for name, value in (("BUCKET", 200), ("CHUNK", 300), ("BLOCK_SETS", 5), ("FREQUENT", 3)):
        monkeypatch.setattr(similarity, name, value)
    monkeypatch.setattr(connected, "BROADCAST_ROWS", 3)


def test_awkward_rows(spark):
    rows = similar_components(awkward(spark)).collect()
    assert Counter(map(tuple, rows)) == expected(awkward_rows())
    assert similar_components(nothing(spark)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_components_against_brute_force(spark, monkeypatch, seed):
    """With buckets, chunks and blocks so small that every step runs over several tasks."""
    small(monkeypatch)
    rows = list(enumerate(families(seed)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert Counter(map(tuple, similar_components(docs).collect())) == expected(rows)


@pytest.mark.parametrize("percent", [10, 25, 40, 90, 100])
def test_other_similarities(spark, monkeypatch, percent):
    """Also those below the share of a set that has to be counted as shared."""
    small(monkeypatch)
    texts = families(percent, 70)
    sets = [shingles(text) for text in texts]
    root = groups(sets, percent)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in similar_components(docs, percent=percent).collect()}
    assert got == {i: r if sets[i] else i for i, r in enumerate(root)}


def test_sets_of_very_different_chunks(spark, monkeypatch):
    """Copies in many chunks, and linked sets of the least and the largest size that can be linked."""
    monkeypatch.setattr(similarity, "CHUNK", 1)
    rng = random.Random(6)
    base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    texts = [" ".join(base[: 400 - n]) for n in (0, 98, 99, 100, 101, 102, 0, 0, 99)]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert Counter(map(tuple, similar_components(docs).collect())) == expected(rows)


def test_words_that_collide_modulo_a_power_of_two(spark):
    def word(letters):
        return "".join(letters[i.bit_count() % 2] for i in range(1024))

    texts = [f"x {w} y z" for w in (word("ab"), word("ba"), word("ab"))]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in similar_components(docs).orderBy("doc_id").collect()]
    assert got == [(0, 1, 0), (1, 1, 1), (2, 1, 0)]


def test_word_hashes_of_blocks():
    """The same word has one hash wherever it stands, and other words have others."""
    data = np.frombuffer(b"ab ba ab aab b ab", np.uint8)
    begin, end = hashing.words(data)
    found = hashing.word_hashes(data, begin, end, hashing.BYTES).tolist()
    assert found[0] == found[2] == found[5] and len(set(found)) == 4
    late = np.frombuffer(b"x" * 100_000 + b" ab", np.uint8)
    begin, end = hashing.words(late)
    assert hashing.word_hashes(late, begin, end, hashing.BYTES)[1] == found[0]


@pytest.mark.parametrize("is_small", [True, False])
def test_pairs_against_brute_force(spark, monkeypatch, is_small):
    if is_small:
        small(monkeypatch)
    rows = list(enumerate(families(3)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    pairs, members = similar_pairs(docs)
    first: dict[frozenset, int] = {}
    for i, text in rows:
        first.setdefault(shingles(text), i)
    sets = [s for s in first if s]
    want = {
        tuple(sorted((first[a], first[b]))) for i, a in enumerate(sets) for b in sets[:i] if linked(a, b)
    }
    got = [tuple(r) for r in pairs.collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 30
    assert {r.doc_id: r.set_id for r in members.collect()} == {
        i: first[shingles(t)] if shingles(t) else None for i, t in rows
    }


@pytest.mark.parametrize("few", [True, False])
def test_one_of_each_group_stays(spark, monkeypatch, few):
    if not few:
        monkeypatch.setattr(common, "BROADCAST_ROWS", -1)
    texts = families(4, 60)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, row string")
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    root = groups([shingles(t) for t in texts])
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, r in enumerate(root) if r == i or not shingles(texts[i])]
    assert one_of_each(nothing(spark)).count() == 0
    assert one_of_each(awkward(spark)).columns == awkward(spark).columns


@pytest.mark.parametrize("spanning", [True, False])
@pytest.mark.parametrize("percent", [50, 75, 100])
def test_tree_finds_what_all_pairs_find(spanning, percent):
    rng = random.Random(percent)
    for _ in range(20):
        base = [rng.sample(range(300), 30) for _ in range(3)]
        sets = []
        for _ in range(rng.randint(2, 60)):
            own = set(rng.choice(base)) ^ set(rng.sample(range(300), rng.randint(0, 8)))
            sets.append(np.array(sorted((x * 0x9E3779B97F4A7C15) % 2**64 for x in own), np.uint64))
        plain = [frozenset(s.tolist()) for s in sets]
        found = list(SignatureTree(sets, percent, spanning=spanning).links())
        want = {(i, j) for i in range(len(sets)) for j in range(i) if linked(plain[i], plain[j], percent)}
        got = {(max(p), min(p)) for p in found}
        if spanning:
            assert got <= want
            parent = list(range(len(sets)))

            def root(i, parent=parent):
                return i if parent[i] == i else root(parent[i])

            for i, j in got:
                assert root(i) != root(j)
                parent[max(root(i), root(j))] = min(root(i), root(j))
            assert [root(i) for i in range(len(sets))] == groups(plain, percent)
        else:
            assert got == want and len(found) == len(got)


def test_sides_and_labels():
    same = [np.arange(10, dtype=np.uint64)] * 4
    assert len(list(SignatureTree(same, 75, np.array([7, 7, 7, 7])).links())) == 0
    assert len(list(SignatureTree(same, 75, np.array([7, 7, 3, 3])).links())) == 1
    sides = SignatureTree(same, 75, spanning=False, side=np.array([0, 0, 1, 1]))
    assert len(list(sides.links())) == 4


@pytest.mark.parametrize("few", [True, False])
def test_connected_components(spark, monkeypatch, few):
    if not few:
        monkeypatch.setattr(connected, "BROADCAST_ROWS", 0)
    rng = random.Random(9)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 400)]
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    parent: dict[int, int] = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    assert {r.node: r.label for r in rows} == {i: root(i) for i in list(parent)}
    assert len(rows) == len(parent)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_arguments(spark):
    with pytest.raises(ValueError):
        similar_components(nothing(spark), k=0)
    with pytest.raises(ValueError):
        similar_components(nothing(spark), percent=0)
