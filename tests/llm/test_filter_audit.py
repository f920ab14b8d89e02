"""All orders of the filters, against plain loops."""

from __future__ import annotations

import random
from itertools import permutations

import pytest

from sluice.llm.filter_audit import METRICS, every_order, mask_cells

from .cases import awkward, awkward_rows, nothing

LABELS = "doc_id long, quality int, toxic int, part string, mask int"


def fails(text: str) -> list[bool]:
    own = [w for w in text.translate(str.maketrans("\t\n\v\f\r", "     ")).split(" ") if w]
    return [
        len(own) < 100,
        100 * len(set(own)) < 80 * len(own),
        100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
        any(c in "#$%&*|" for c in text),
    ]


def plain(docs, labels):
    """docs: id, text, part."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    least: dict[str, int] = {}
    for d, text, _ in docs:
        if d is not None:
            least[text or ""] = min(d, least.get(text or "", d))
    rows = []
    for d, text, part in docs:
        own = [*fails(text or ""), d is not None and least[text or ""] < d]
        rows.append((part or "", dict(zip("ABCDE", own)), d in good, d in toxic))
    out, totals = {}, {}
    for part in {r[0] for r in rows}:
        for order in permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            gone = []
            for step, letter in enumerate(order, 1):
                redundant = sum(r[1][letter] for r in gone)
                now = [r for r in left if r[1][letter]]
                left = [r for r in left if not r[1][letter]]
                gone += now
                alone = sum(r[1][letter] and sum(r[1].values()) == 1 for r in rows if r[0] == part)
                out[part, "".join(order), step] = [
                    len(left), len(now), redundant, alone, sum(r[2] for r in now), sum(r[3] for r in now)
                ]
                totals[part, letter] = totals.get((part, letter), 0) + len(now)
    return {k: (*v, totals[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def got(rows):
    found = {(r.part, r.filter_order, r.step): tuple(r[m] for m in (*METRICS, "shapley")) for r in rows}
    assert len(found) == len(rows) and all(r.letter == r.filter_order[r.step - 1] for r in rows)
    return found


def audit(docs, labels):
    return every_order(mask_cells(docs, labels), "ABCDE").collect()


def test_against_plain_loops(spark):
    rng = random.Random(3)
    texts = [None, "", "Some Text", "a b", "50 % off", "LOUD", "x " * 150, "X " * 150 + "#"]
    texts += [" ".join(f"w{rng.randrange(n)}" for _ in range(120)) for n in (20, 200, 2000)]
    docs = [(i if i % 9 else None, rng.choice(texts), rng.choice(["en", "de", "", None])) for i in range(300)]
    docs += docs[:20]
    labels = [(rng.randrange(320), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(200)]
    labels.append((None, 1, 1))
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(5)
    named = spark.createDataFrame([(*row, "x", 3) for row in labels], LABELS)
    assert got(audit(table, named)) == plain(docs, labels)


def test_awkward_and_empty_tables(spark):
    empty = spark.createDataFrame([], LABELS)
    rows = awkward_rows()
    assert got(audit(awkward(spark), empty)) == plain([(r[0], r[1], r[2]) for r in rows], [])
    assert audit(nothing(spark), empty) == []


def test_many_parts_and_other_letters(spark):
    """More rows than a recursive query returns by default; each part has every order and step."""
    cells = spark.range(40_000).selectExpr(
        "cast(id % 20000 as string) AS part", "cast(id % 3 as int) AS mask", "1L AS n", "0L AS good", "0L AS toxic"
    )
    cells = cells.groupBy("part", "mask").sum("n", "good", "toxic").toDF("part", "mask", "n", "good", "toxic")
    rows = every_order(cells, "xyzv").groupBy("step").count().collect()
    assert {r.step: r["count"] for r in rows} == dict.fromkeys((1, 2, 3, 4), 20_000 * 24)
    with pytest.raises(ValueError):
        every_order(cells, "xx")
