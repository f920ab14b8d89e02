"""Small tables with the cases that every operator must bear, and plain models to compare with."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that clash with names the operators use.
CLASHING = "size long, row string, n int, `a.b` string, score double, part string, hash string, block int"

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WORD = re.compile("[^\x20\x09-\x0d]+")


def awkward_rows() -> list[tuple]:
    """Nulls in every column, empty and blank texts, ties, repeated rows and ids, a very long text."""
    long = " ".join(f"word{i % 977} and{i % 13}" for i in range(30_000))
    texts = [
        (1, "Same text here", "en", "a", 14),
        (2, "Same  text\there", "en", "a", 15),
        (3, "Sametexthere", "en", None, 12),
        (4, "", "de", "b", 0),
        (5, None, None, "b", None),
        (6, " \n\t ", "de", None, 4),
        (7, "one", None, "c", 3),
        (7, "one", None, "c", 3),
        (8, "ONE", "en", "c", 3),
        (None, "a row without an id", "en", "a", 19),
        (None, "a row without an id", "en", "a", 19),
        (None, None, None, None, None),
        (9, long, "en", "a", len(long)),
        (10, long + " tail", "en", "d", len(long) + 5),
        (11, "Grüße aus 東京 😀   nb sp", "de", "é", 24),
        (12, "tie one two three four five six", "en", "e", 31),
        (13, "tie one two three four five six", "en", "e", 31),
        (9, "another text under a used id", "en", "a", 28),
    ]
    return texts


def awkward(spark: SparkSession) -> DataFrame:
    extra = (None, "x", 1, None, 0.5, None, "h", 2)
    rows = [(*row, *extra) for row in awkward_rows()]
    return spark.createDataFrame(rows, f"{DOCS}, {CLASHING}").repartition(3)


def nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], f"{DOCS}, {CLASHING}")


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").translate(_LOWER))


def shingles(text: str | None, k: int = 5) -> frozenset:
    found = words(text)
    if len(found) < k:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + k]) for i in range(len(found) - k + 1))


def linked(a: frozenset, b: frozenset, percent: int = 75) -> bool:
    both = len(a & b)
    return bool(a) and bool(b) and 100 * both >= percent * (len(a) + len(b) - both)


def groups(sets: list[frozenset], percent: int = 75) -> list[int]:
    """For each set the place of the first of its group."""
    parent = list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if linked(sets[i], sets[j], percent):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(sets))]


def families(seed: int, n: int = 120) -> list[str]:
    """Texts of which many are altered copies of others, with passages that many share."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=60)
    out: list[list[str]] = []
    while len(out) < n:
        kind = rng.random()
        if out and kind < 0.6:
            text = list(rng.choice(out))
            for _ in range(rng.randint(0, 6)):
                if text:
                    text[rng.randrange(len(text))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                text = text[rng.randint(0, 5) :]
        else:
            text = rng.choices(vocabulary, k=rng.choice([0, 1, 3, 4, 5, 6, 20, 60, 150]))
            if rng.random() < 0.4:
                at = rng.randint(0, len(text))
                text[at:at] = passage
        out.append(text)
    return [" ".join(t) if rng.random() < 0.8 else "\n".join(t).upper() for t in out]
