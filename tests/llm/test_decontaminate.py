"""Item windows in documents, against a plain search."""

from __future__ import annotations

import random
import re

import pytest

from sluice.llm import decontaminate
from sluice.llm.decontaminate import benchmark_hits, decontaminated

from .cases import awkward, awkward_rows, nothing

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
ITEMS = "item_id string, text string, words int, `a.b` string"


def word_list(text):
    return _WORD.findall((text or "").translate(_LOWER))


def plain(texts, items, window=10):
    """For each text the number of words, the hit places and the items."""
    wanted = {}
    for item, text in items:
        own = word_list(text)
        size = min(window, len(own))
        for i in range(len(own) - size + 1 if own else 0):
            wanted.setdefault(tuple(own[i : i + size]), set()).add(item)
    sizes = {len(w) for w in wanted}
    out = []
    for text in texts:
        own, hit, found = word_list(text), set(), set()
        for size in sizes:
            for i in range(len(own) - size + 1):
                if tuple(own[i : i + size]) in wanted:
                    hit.update(range(i, i + size))
                    found |= wanted[tuple(own[i : i + size])]
        out.append((len(own), frozenset(hit), tuple(sorted(f for f in found if f is not None))))
    return out


def got(rows, id_col="doc_id"):
    out = []
    for r in rows:
        places = [p for s in r.spans for p in range(s.start, s.end)]
        assert len(places) == len(set(places))
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))
        out.append((r[id_col], (r.n_words, frozenset(places), tuple(r["items"]))))
    return sorted(out, key=repr)


def made(seed, vocabulary=30):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(vocabulary)] + ["é", "東京", "x1"]
    items = []
    for i in range(40):
        own = rng.choices(vocab, k=rng.choice([0, 1, 2, 4, 5, 7, 9, 10, 11, 25, 60]) if i % 4 == 0 else 30)
        if len(own) < 3:
            own = [f"rare{w}" for w in own]  # else every document is hit throughout
        items.append((f"i{i % 37}" if i else None, rng.choice([" ", ", ", "\n"]).join(own)))
    items += [("none", None), ("empty", ""), ("signs", "... - !"), items[5]]
    texts = []
    for _ in range(60):
        own = rng.choices(vocab, k=rng.choice([0, 3, 20, 200]))
        for _ in range(rng.randint(0, 3)):
            source = word_list(rng.choice(items)[1])
            a = rng.randint(0, len(source))
            at = rng.randint(0, len(own))
            own[at:at] = source[a : a + rng.choice([3, 9, 10, 11, 14, 100])]
        texts.append((" - " if rng.random() < 0.3 else " ").join(own))
        if rng.random() < 0.3:
            texts[-1] = texts[-1].upper()
    return texts, items


@pytest.mark.parametrize("seed,window,shingle", [(1, 10, 5), (2, 10, 10), (3, 4, 2), (4, 6, 3)])
def test_against_a_plain_search(spark, seed, window, shingle):
    texts, items = made(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame([(*item, 1, "x") for item in items], ITEMS)
    expected = sorted(enumerate(plain(texts, items, window)), key=repr)
    assert got(benchmark_hits(docs, bench, window, shingle).collect()) == expected


def test_a_crowded_bitmap_only_adds_candidates(spark, monkeypatch):
    """With nearly every bit set every run leaves the scan, and the result is the same."""
    texts, items = made(5, vocabulary=4000)
    monkeypatch.setattr(decontaminate, "BITS", 1 << 16)
    monkeypatch.setattr(decontaminate, "_filter", lambda *a, real=decontaminate._filter: _full(real(*a)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(*item, 1, "x") for item in items], ITEMS)
    assert got(benchmark_hits(docs, bench).collect()) == sorted(enumerate(plain(texts, items)), key=repr)


def _full(made_filter):
    made_filter.bits[:] = 255
    return made_filter


def test_awkward_rows(spark):
    rows = awkward_rows()
    long = rows[12][1]
    items = [("long", long), ("tie", "TIE one, two"), ("none", None), (None, "one"), ("r", "a row without an id")]
    bench = spark.createDataFrame([(*item, 1, "x") for item in items], ITEMS)
    found = benchmark_hits(awkward(spark), bench)
    assert found.columns == ["doc_id", "n_words", "spans", "items"]
    expected = zip([r[0] for r in rows], plain([r[1] for r in rows], items))
    assert got(found.collect()) == sorted(expected, key=repr)


def test_empty_tables(spark):
    bench = spark.createDataFrame([], ITEMS)
    rows = benchmark_hits(awkward(spark), bench).collect()
    assert len(rows) == len(awkward_rows()) and not any(r.spans or r["items"] for r in rows)
    some = spark.createDataFrame([("a", "one two three", 1, "x")], ITEMS)
    assert benchmark_hits(nothing(spark), some).collect() == []
    assert benchmark_hits(nothing(spark), bench).collect() == []


def test_decontaminated_keeps_clean_documents(spark):
    text = " ".join(f"q{i}" for i in range(12))
    docs = spark.createDataFrame([(1, "clean words"), (2, "so " + text), (3, text + " and" * 88)], "doc_id int, text string")
    bench = spark.createDataFrame([("a", text, 1, "x")], ITEMS)
    assert [r.doc_id for r in decontaminated(docs, bench).collect()] == [1]
    assert sorted(r.doc_id for r in decontaminated(docs, bench, most=0.2).collect()) == [1, 3]


def test_pieces_of_a_long_text(monkeypatch):
    """A text hashed in pieces of a few bytes has the words and hashes of the whole."""
    text = "alpha béta gamma東 x  ,, delta".encode() * 20
    whole = decontaminate._word_hashes(text)
    monkeypatch.setattr(decontaminate, "PIECE", 7)
    for a, b in zip(whole, decontaminate._word_hashes(text)):
        assert (a == b).all()
    assert [text[a:b].decode() for a, b in zip(*whole[:2])] == _WORD.findall(text.decode())


def test_options_are_checked(spark):
    with pytest.raises(ValueError):
        benchmark_hits(nothing(spark), spark.createDataFrame([], ITEMS), window=4, shingle=5)
