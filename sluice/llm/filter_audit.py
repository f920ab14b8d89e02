"""What each filter of a corpus removes, in every order that the filters may be applied in.

1. One scan finds which filters each document fails, as bits of a mask, and a SHA-256 of its text.
   Only ids, hashes, parts and masks are kept.
2. Whether a smaller id has the same text is found by a join on hash *and* id, so the copies of
   one text are spread over the tasks; the least id of a text comes from a partial aggregate.
3. Rows are counted in mask cells: at most 2 to the number of filters for each part.
4. A recursive query starts from the cells with no filter applied. Each level extends every prefix
   by each unused letter, joins the cells again, carries the bits applied so far and emits the
   metrics of that step. Prefixes that several orders share are computed once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import WORD, quoted, written

#: Failure conditions by letter, as SQL on text, never null, and words, an array of the words of it.
TEXT_FILTERS = {
    "A": "size(words) < 100",
    "B": "100L * size(array_distinct(words)) < 80L * size(words)",
    "C": "100L * char_length(regexp_replace(text, '[^A-Z]+', '')) > 10L * char_length(text)",
    "D": "text rlike '[#$%&*|]'",
}

METRICS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")

_STEPS = """
WITH RECURSIVE steps AS (
    SELECT part, mask, '' AS prefix, '' AS letter, 0 AS step, 0 AS applied, n AS kept, 0L AS removed,
           0L AS redundant, 0L AS unique_fails, 0L AS good_lost, 0L AS toxic_lost
    FROM {{cells}}
    UNION ALL
    SELECT c.part, c.mask, concat(s.prefix, s.next), s.next, s.step + 1, s.applied | s.bit,
           if(c.mask & (s.applied | s.bit) = 0, c.n, 0L),
           if(c.mask & s.applied = 0 AND c.mask & s.bit <> 0, c.n, 0L),
           if(c.mask & s.applied <> 0 AND c.mask & s.bit <> 0, c.n, 0L),
           if(c.mask = s.bit, c.n, 0L),
           if(c.mask & s.applied = 0 AND c.mask & s.bit <> 0, c.good, 0L),
           if(c.mask & s.applied = 0 AND c.mask & s.bit <> 0, c.toxic, 0L)
    FROM (
        SELECT part, mask, prefix, step, applied, next, shiftleft(1, locate(next, '{letters}') - 1) AS bit
        FROM steps LATERAL VIEW explode(filter(array({each}), x -> locate(x, prefix) = 0)) AS next
    ) s JOIN {{cells}} c ON c.part = s.part AND c.mask = s.mask
)
SELECT part, prefix, letter, step, {sums}
FROM (SELECT * FROM steps LIMIT ALL) WHERE step > 0 GROUP BY part, prefix, letter, step
"""


def mask_cells(
    docs: DataFrame,
    labels: DataFrame,
    filters: Mapping[str, str] = TEXT_FILTERS,
    repeats: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """Rows (part, mask, n, good, toxic): documents, by part, that fail just the filters of the mask.

    The first of `filters` has bit 0. With `repeats` there is one bit after theirs, failed by a text
    that is that of a smaller id anywhere in the table. Null texts are empty, null parts ''. A null
    id is never the smaller one nor the larger. Rows repeated with id and text do not fail for each
    other. `good` and `toxic` count documents with a label row of quality 1 and of toxic 1; several
    label rows of an id count as one. Other columns are left out; an empty table gives no rows.
    """
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        quoted(id_col).alias("doc"), F.coalesce(quoted(part_col).cast("string"), F.lit("")).alias("part"),
        text.alias("text"),
    )
    rows = rows.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    mask = F.lit(0)
    for place, fails in enumerate(filters.values()):
        mask = mask + F.when(F.expr(fails), F.lit(1 << place)).otherwise(F.lit(0))
    sha = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    facts = written(rows.select("doc", "part", sha.alias("sha"), mask.alias("mask")), "facts")

    known = labels.select(
        quoted(id_col).alias("doc"), (quoted("quality") == 1).alias("good"), (quoted("toxic") == 1).alias("toxic")
    )
    known = known.filter("doc is not null and (good or toxic)").groupBy("doc")
    known = known.agg(F.coalesce(F.max("good"), F.lit(False)).alias("good"),
                      F.coalesce(F.max("toxic"), F.lit(False)).alias("toxic"))
    named = facts.filter("doc is not null").join(known, "doc", "left")
    if repeats:
        first = facts.filter("doc is not null").groupBy("sha").agg(F.min("doc").alias("doc"))
        named = named.join(first.withColumn("first", F.lit(True)), ["doc", "sha"], "left")
        again = F.when(F.col("first"), F.lit(0)).otherwise(F.lit(1 << len(filters)))
        named = named.withColumn("mask", F.col("mask") + again)
    columns = ["part", "mask", F.coalesce("good", F.lit(False)).cast("long").alias("good"),
               F.coalesce("toxic", F.lit(False)).cast("long").alias("toxic")]
    nameless = facts.filter("doc is null").select("part", "mask", F.lit(0).cast("long").alias("good"),
                                                  F.lit(0).cast("long").alias("toxic"))
    cells = named.select(*columns).unionByName(nameless).groupBy("part", "mask")
    return cells.agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))


def every_order(cells: DataFrame, letters: str) -> DataFrame:
    """Rows (part, filter_order, step, letter, METRICS, shapley) for all orders of `letters`.

    `cells` as of `mask_cells`; bit i of a mask stands for the i-th letter. Zeros are included: each
    part of a cell has every order and step. `shapley` is what the step's filter removes, summed
    over all orders. The letters are few and distinct: the orders are their permutations.
    """
    if not letters.isalpha() or len(set(letters)) != len(letters):
        raise ValueError(f"the letters must be distinct: {letters!r}")
    sums = ", ".join(f"sum({m}) AS {m}" for m in METRICS)
    each = ", ".join(f"'{letter}'" for letter in letters)
    query = _STEPS.format(letters=letters, each=each, sums=sums)
    steps = written(cells.sparkSession.sql(query, cells=written(cells, "cells")), "steps")
    last = len(letters)
    # a prefix of i letters begins (last - i)! orders
    share = F.sum(F.col("removed") * F.factorial(F.lit(last) - F.col("step"))).alias("shapley")
    shares = steps.groupBy("part", "letter").agg(share)
    orders = steps.filter(F.col("step") == last).select("part", F.col("prefix").alias("filter_order"))
    orders = orders.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(last))))
    orders = orders.withColumn("prefix", F.substring("filter_order", F.lit(1), F.col("step")))
    rows = orders.join(steps, ["part", "prefix", "step"]).join(shares, ["part", "letter"])
    return rows.select("part", "filter_order", "step", "letter", *METRICS, "shapley")
