from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sluice.llm import common, dedup
from sluice.llm.dedup import deduplicated, exact_duplicates
from sluice.llm.mixing import CURRICULUM, Schedule, in_training_order, mix, mixed_documents, targets

from .cases import DOCS, awkward, awkward_rows, nothing, words


def model(rows: list[tuple]) -> Counter:
    normal = [re.sub("[\x20\x09-\x0d]+", "", text or "") for _, text, *_ in rows]
    best: dict[str, tuple] = {}
    for (doc, text, *_), key in zip(rows, normal):
        rank = (-len(text or ""), doc is None, doc or 0)
        best[key] = min(best.get(key, rank), rank)
    size = Counter(normal)
    out = Counter()
    for (doc, text, *_), key in zip(rows, normal):
        points, no_id, kept = best[key]
        kept = None if no_id else kept
        sha = hashlib.sha256(key.encode()).hexdigest()
        out[doc, kept, size[key], doc == kept and -points == len(text or ""), sha] += 1
    return out


@pytest.mark.parametrize("few", [True, False])
@pytest.mark.parametrize("weak", [True, False])
def test_exact_duplicates(spark, monkeypatch, few, weak):
    """Also with a hash under which many texts collide, and with the shuffled join."""
    if not few:
        monkeypatch.setattr(common, "BROADCAST_ROWS", -1)
    hashing = {"hash_of": lambda c: F.lit(b"x")} if weak else {}
    rows = exact_duplicates(awkward(spark), **hashing).collect()
    assert Counter(map(tuple, rows)) == model(awkward_rows())
    assert exact_duplicates(nothing(spark), **hashing).count() == 0


def test_only_texts_of_repeated_hashes_pass_the_bitmap(spark):
    """Whatever the number of rows, texts that occur once do not move, but for a few that share a bit."""
    texts = spark.range(20_000).selectExpr("concat('text ', id % 19990) AS content")
    hashed = texts.withColumn("hash", dedup.content_hash(F.col("content")))
    several = hashed.groupBy("hash").count().filter("count > 1").select("hash")
    passing = hashed.filter(common.in_bitmap(F.col("hash"), common.bitmap(several)))
    assert 20 <= passing.count() <= 22
    assert passing.join(several, "hash", "left_semi").count() == 20
    none = hashed.filter(common.in_bitmap(F.col("hash"), common.bitmap(several.limit(0))))
    assert none.count() == 0


def test_a_crowded_bitmap_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(common, "BITS", 64)
    monkeypatch.setattr(common, "BROADCAST_ROWS", -1)
    rows = exact_duplicates(awkward(spark)).collect()
    assert Counter(map(tuple, rows)) == model(awkward_rows())


@pytest.mark.parametrize("few", [True, False])
def test_deduplicated_keeps_rows_whole(spark, monkeypatch, few):
    if not few:
        monkeypatch.setattr(common, "BROADCAST_ROWS", -1)
    docs = awkward(spark)
    kept = deduplicated(docs)
    assert kept.columns == docs.columns
    texts = Counter(re.sub("[\x20\x09-\x0d]+", "", r.text or "") for r in kept.collect())
    assert set(texts.values()) == {1}
    assert len(texts) == len({re.sub("[\x20\x09-\x0d]+", "", r[1] or "") for r in awkward_rows()})
    assert deduplicated(nothing(spark)).count() == 0


def plain_targets(sizes: dict, percent: int = 150, most: int = 2) -> dict:
    names = sorted((n for n in sizes if n is not None), key=lambda n: [ord(c) for c in n])
    names += [None] if None in sizes else []
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    capped: set = set()
    while True:
        left = percent / 100 * sum(sizes.values()) - sum(most * sizes[n] for n in capped)
        free = sum(w for n, w in weight.items() if n not in capped)
        share = {n: most * sizes[n] if n in capped else weight[n] * left / free for n in names}
        over = {n for n in names if n not in capped and share[n] > most * sizes[n]}
        if not over:
            return share
        capped |= over


def test_mix_reaches_its_targets(spark):
    rows = awkward_rows()
    sizes: dict = defaultdict(int)
    for _, text, _, source, _ in rows:
        sizes[source] += len(words(text))
    wanted = plain_targets(dict(sizes))
    mixed = mix(awkward(spark))
    got = mixed.collect()
    assert len(got) == len(rows)
    taken: dict = defaultdict(int)
    for row in got:
        assert 0 <= row.taken <= 2 * row.size and row.source_size == sizes[row.source]
        assert row.target == pytest.approx(wanted[row.source])
        assert len(row.positions) == -(-row.taken // row.size if row.size else 0)
        assert all(0 <= p <= 1 for p in row.positions) and row.positions == sorted(row.positions)
        taken[row.source] += row.taken
    for source, n in taken.items():
        assert abs(n - wanted[source]) <= 0.5
    assert Counter(map(str, got)) == Counter(map(str, mix(awkward(spark)).collect()))
    assert mix(nothing(spark)).count() == 0
    order = [r.position for r in in_training_order(mixed).collect()]
    assert order == sorted(order)


def test_mix_over_many_ranges(spark, monkeypatch):
    from sluice.llm import mixing

    docs = spark.range(500).selectExpr(
        "id doc_id", "repeat('w ', int(id % 17)) text", "concat('s', cast(floor(sqrt(id / 20)) as string)) source"
    )
    one = Counter(map(str, mix(docs).drop("positions").collect()))
    monkeypatch.setattr(mixing, "RANGE_ROWS", 3)
    assert Counter(map(str, mix(docs).drop("positions").collect())) == one


def test_sources_without_words(spark):
    rows = [(1, "", "en", "a", 0), (2, None, "en", "b", None)]
    got = mix(spark.createDataFrame(rows, DOCS)).collect()
    assert [(r.taken, r.target, r.positions) for r in got] == [(0, 0.0, []), (0, 0.0, [])]


def test_positions_follow_the_schedule(spark):
    """Half of a source whose weight falls from 2 to 0 is read by the time 1 - sqrt(1/2)."""
    fading, coming = Schedule(((0.0, 2.0), (1.0, 0.0))), Schedule(((0.0, 0.0), (0.5, 0.0), (1.0, 4.0)))
    share = spark.range(101).select((F.col("id") / 100).alias("x"))
    for schedule, time in ((fading, lambda x: 1 - (1 - x) ** 0.5), (coming, lambda x: 0.5 + (x / 4) ** 0.5)):
        for row in share.select("x", schedule.time_of(F.col("x")).alias("t")).collect():
            if row.x:
                assert row.t == pytest.approx(time(row.x))
    assert [s.integral() for s in CURRICULUM] == [5, 2, 1]
    with pytest.raises(ValueError):
        Schedule(((0.0, 1.0), (0.5, 1.0)))
    with pytest.raises(ValueError):
        Schedule(((0.0, -1.0), (1.0, 1.0)))


def test_targets_with_all_sources_capped(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 0), (None, 5)], "source string, source_size long")
    got = {r.source: r.target for r in targets(sizes, CURRICULUM, percent=200).collect()}
    assert got == {"a": 20.0, "b": 0.0, None: 10.0}


def test_mixed_documents_repeat_and_cut(spark):
    docs = awkward(spark)
    mixed = mix(docs)
    out = mixed_documents(docs, mixed, length_col="n_chars")
    assert out.columns == docs.columns
    rows = out.collect()
    assert sum(len(words(r.text)) for r in rows) == sum(r.taken for r in mixed.collect())
    texts = {r[1] for r in awkward_rows()}
    for row in rows:
        assert any((t or "").startswith(row.text) for t in texts)
        assert row.text in texts or row.n_chars == len(row.text)
    assert mixed_documents(nothing(spark), mix(nothing(spark))).count() == 0
