"""The registered queries: against SQL, or against plain Python where SQL cannot express them."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

import __spark_entry__ as registered
import corpus_pipeline
from checks.compare import spark_rows, sql_rows
from sluice.llm import langid, tokens
from sluice.llm.common import written
from sluice.llm.mixing import mix
from sluice.llm.queries import QUERIES, tokenizer
from sluice.llm.sql import SQL

from .cases import awkward, groups, nothing, shingles

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def test_all_are_registered():
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(registered.queries())
    assert set(SQL) <= set(registered.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, name):
    names, got = spark_rows(spark, name, SMALL)
    expected_names, expected = sql_rows(name, SMALL)
    assert names == expected_names and got == expected


def ids_of(text: str, end: int) -> np.ndarray:
    coder = tokens.encoder(tokenizer())
    return np.append(np.frombuffer(coder.whole(text), coder.dtype), end).astype("<u4")


def test_op8(spark, texts):
    place = 0
    rows = QUERIES["op8_token_files"](spark, SMALL).orderBy("doc_id").collect()
    assert [r.doc_id for r in rows] == sorted(texts)
    for r in rows:
        ids = ids_of(texts[r.doc_id].text, 2)
        assert (r.start, r.n_tokens, r.ids_crc32) == (place, len(ids), zlib.crc32(ids.tobytes()))
        place += len(ids)


def test_op2(spark, texts):
    rows = QUERIES["op2_packing"](spark, SMALL).collect()
    used = Counter()
    held = Counter()
    for r in rows:
        ids = ids_of(texts[r.doc_id].text, 0)
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
        used[r.sequence_id] += r.length
        held[r.doc_id] += r.length
    assert max(used.values()) <= 1024
    assert held == {d: len(ids_of(r.text, 0)) for d, r in texts.items()}
    assert sum(used.values()) > 0.98 * 1024 * len(used)


def test_op1_and_op7_return_every_document(spark, texts):
    for name, of, held in (("op1_language_id", 4, 2), ("op7_toxicity", 3, 1)):
        rows = QUERIES[name](spark, SMALL).collect()
        assert sorted(r.doc_id for r in rows) == sorted(texts)
        for r in rows:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % of == held) and 0 <= r.score <= 1


def test_op7_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op7_toxicity"](spark, sf).collect() if r.held_out and labels.get(r.doc_id) is not None]
    hits = sum(r.predicted and labels[r.doc_id] == 1 for r in rows)
    assert hits >= 0.85 * sum(labels[r.doc_id] == 1 for r in rows)
    assert hits >= 0.85 * sum(r.predicted for r in rows)


def test_pipeline_stages_against_plain_python(spark, texts):
    """Each stage on what its predecessor kept."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["language"](spark, docs, SMALL).cache()
    assert kept.columns == docs.columns and kept.count() >= 0.98 * docs.count()
    once = stages["exact_dedup"](spark, kept, SMALL).cache()
    plain: dict[str, tuple] = {}
    for r in kept.collect():
        key = "".join(c for c in r.text if c not in " \t\n\v\f\r")
        plain[key] = min(plain.get(key, (1, 0)), (-len(r.text), r.doc_id))
    assert sorted(r.doc_id for r in once.collect()) == sorted(d for _, d in plain.values())
    apart = stages["near_dedup"](spark, once, SMALL).cache()
    rows = sorted(once.collect(), key=lambda r: r.doc_id)
    root = groups([shingles(r.text) for r in rows])
    assert sorted(r.doc_id for r in apart.collect()) == [r.doc_id for i, r in enumerate(rows) if root[i] == i]
    mixed = stages["mixing"](spark, apart, SMALL).cache()
    assert mixed.columns == docs.columns
    size = sum(len(r.text.split()) for r in apart.collect())
    assert sum(len(r.text.split()) for r in mixed.collect()) == pytest.approx(1.5 * size, rel=0.01)
    packed = stages["packing"](spark, mixed, SMALL)
    got = Counter()
    for r in packed.collect():
        got[r.doc_id] += r.length
    want = Counter()
    for r in mixed.collect():
        want[r.doc_id] += len(ids_of(r.text, 0))
    assert got == want


def test_sequences_read_in_order_of_position_follow_the_training_time(spark, monkeypatch):
    """The curriculum reaches the last stage: later sequences hold documents of later readings."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(6)
    mixed = written(corpus_pipeline.mixing(spark, docs, sf), "mixed")
    time_of: dict[int, list] = {}
    for r in mix(docs).collect():
        time_of[r.doc_id] = r.positions
    packed = corpus_pipeline.packing(spark, mixed, sf).collect()
    position, times = {}, {}
    for r in packed:
        assert position.setdefault(r.sequence_id, r.position) == r.position
        if len(time_of[r.doc_id]) == 1:
            times.setdefault(r.sequence_id, []).extend(time_of[r.doc_id] * r.length)
    order = sorted(times, key=position.get)
    tenths = np.array_split(order, 10)
    means = [np.mean([np.mean(times[s]) for s in part]) for part in tenths]
    # a document of one reading may stand in a window that stayed open, so by tenths, not one by one
    assert all(a < b for a, b in zip(means, means[1:])) and means[0] < 0.12 and means[-1] > 0.88


def test_mixing_against_a_plain_computation(spark, texts):
    """Which documents are read, how often and how far, in each source."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = sorted(docs.collect(), key=lambda r: (hashlib.md5(str(r.doc_id).encode()).hexdigest(), r.doc_id))
    size = {r.doc_id: len(re.findall("[^\x20\x09-\x0d]+", r.text or "")) for r in rows}
    total = Counter()
    for r in rows:
        total[r.source] += size[r.doc_id]
    names = sorted(total, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target: dict = {}
    while len(target) < len(names):
        left = Fraction(3, 2) * sum(total.values()) - sum(target.values())
        free = [s for s in names if s not in target]
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > 2 * total[s]]
        target.update({s: 2 * total[s] for s in over} if over else share)
    wanted = Counter()
    for source in names:
        words = math.floor(target[source] + Fraction(1, 2))
        for _ in range(2):
            for r in rows:
                if r.source == source and words > 0 and size[r.doc_id]:
                    wanted[r.doc_id, min(words, size[r.doc_id])] += 1
                    words -= size[r.doc_id]
    got = Counter()
    for r in corpus_pipeline.mixing(spark, docs, SMALL).collect():
        found = len(re.findall("[^\x20\x09-\x0d]+", r.text))
        assert texts[r.doc_id].text.startswith(r.text) and r.source == texts[r.doc_id].source
        got[r.doc_id, found] += 1
    assert got == wanted


def test_the_language_stage_against_a_plain_loop(spark):
    """On the given rows and on noise, which must go: the same rows stay, and each as it was."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    letters = np.random.default_rng(0).choice(list("abcdefghijklmnopqrstuvwxyz   "), (5, 1500))
    noise = [(-1 - i, "".join(row), None, "x", 1500) for i, row in enumerate(letters.tolist())]
    docs = docs.unionByName(spark.createDataFrame(noise, docs.schema))
    languages = langid.learn(docs)
    limits = languages.limits()
    want = []
    for r in docs.collect():
        content = langid.letters(r.text or "")
        if not content:
            continue
        sizes = sorted(size for size, _ in languages.sizes(content))
        place = sum(len(content) >= n for n in langid.LENGTHS[:-1])
        if (sizes[1] - sizes[0]) / sizes[0] >= limits[place]:
            want.append(tuple(r))
    got = [tuple(r) for r in dict(corpus_pipeline.STAGES)["language"](spark, docs, SMALL).collect()]
    assert sorted(got) == sorted(want) and min(r[0] for r in got) >= 0


def test_the_pipeline_bears_awkward_and_empty_tables(spark, tmp_path):
    for i, table in enumerate((awkward(spark), nothing(spark))):
        table.write.parquet(f"file:{tmp_path}/{i}/documents.parquet")
        rows = corpus_pipeline.run(spark, f"file:{tmp_path}/{i}").collect()
        assert bool(rows) == (i == 0)
        if rows:
            assert set(rows[0].asDict()) == {"doc_id", *corpus_pipeline.PIECE}
