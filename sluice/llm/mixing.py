"""Mixing sources to target weights along a curriculum that changes with training time.

Training time runs from 0 to 1. A source's schedule is a weight over time, linear between knots.
Its integral is the source's weight in the mix, which fixes how many words it gives in all; the
integral up to time t, scaled to that total, is its demand at t. Documents of a source stand in a
fixed pseudo-random order; the words before a document are its demand, and inverting the demand
gives the time at which it is read. Sorting by that time gives the training order.

The running sums within a source are made from sums of hash ranges, so that a source with a third
of all rows is spread over many tasks. What is joined by broadcast has a row per source or per
range of a source.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import SPACES, WORD, quoted, written

#: Rows of one hash range, about.
RANGE_ROWS = 20_000


@dataclass(frozen=True)
class Schedule:
    """Weights at knots over time; `knots` are (time, weight) from time 0 to time 1."""

    knots: tuple[tuple[float, float], ...]

    def __post_init__(self) -> None:
        times = [t for t, _ in self.knots]
        if len(times) < 2 or times[0] != 0 or times[-1] != 1 or times != sorted(set(times)):
            raise ValueError("knots must go from time 0 to time 1")
        if any(w < 0 for _, w in self.knots) or not self.integral():
            raise ValueError("weights must not be negative, nor all be zero")

    def pieces(self) -> list[tuple[float, float, float, float, float]]:
        """Time, length, weight, slope and integral before, of each piece."""
        out, before = [], 0.0
        for (a, u), (b, v) in zip(self.knots, self.knots[1:]):
            out.append((a, b - a, u, (v - u) / (b - a), before))
            before += (b - a) * (u + v) / 2
        return out

    def integral(self) -> float:
        return sum((b - a) * (u + v) / 2 for (a, u), (b, v) in zip(self.knots, self.knots[1:]))

    def time_of(self, share: Column) -> Column:
        """The time by which this share of the integral is reached."""
        wanted = share * F.lit(self.integral())
        out = F.lit(1.0)
        for a, length, u, slope, before in reversed(self.pieces()):
            need = F.greatest(wanted - F.lit(before), F.lit(0.0))
            # u x + slope x^2 / 2 = need, in the form that also holds for slope 0
            root = F.sqrt(F.greatest(F.lit(u * u) + F.lit(2 * slope) * need, F.lit(0.0)))
            at = F.when(need <= 0, F.lit(0.0)).otherwise(2 * need / (F.lit(u) + root))
            end = before + length * (u + slope * length / 2)
            out = F.when(wanted <= F.lit(end), F.lit(a) + F.least(at, F.lit(length))).otherwise(out)
        return out


#: The default mix: weights 5, 2 and 1; the first fades out, the last comes in.
CURRICULUM = (
    Schedule(((0.0, 7.5), (1.0, 2.5))),
    Schedule(((0.0, 2.0), (1.0, 2.0))),
    Schedule(((0.0, 0.5), (1.0, 1.5))),
)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def targets(
    sizes: DataFrame, schedules: tuple[Schedule, ...], percent: int = 150, most_epochs: int = 2
) -> DataFrame:
    """From rows (source, source_size) the words each source gives: adds kind, target, wanted.

    Sources in order of code points, null last, take the schedules in turn. They share `percent`
    of all words by weight; none gives more than `most_epochs` times its size, and what is over
    goes to the others by weight until none is above.
    """
    whole = Window.partitionBy(F.lit(0)).orderBy(F.col("source").isNull(), "source")
    weights = F.array(*(F.lit(s.integral()) for s in schedules))
    listed = sizes.withColumn("kind", (F.row_number().over(whole) - 1) % len(schedules))
    listed = listed.withColumn("weight", F.element_at(weights, F.col("kind").cast("int") + 1))
    # in hundredths of a word; those with the least cap for their weight are capped first
    listed = listed.withColumn("cap", F.col("source_size") * (100 * most_epochs))
    by_need = Window.partitionBy(F.lit(0)).orderBy(
        F.col("cap") / F.col("weight"), F.col("source").isNull(), "source"
    )
    upto, every = by_need.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(0))
    listed = listed.withColumns(
        {
            "left": F.sum("source_size").over(every) * percent - F.coalesce(F.sum("cap").over(upto), F.lit(0)),
            "weights": F.sum("weight").over(by_need.rowsBetween(0, Window.unboundedFollowing)),
        }
    )
    # the first source that stays below its cap: from it on, all share what is left
    free = F.col("left") * F.col("weight") <= F.col("cap") * F.col("weights")
    place = (F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    first = F.min(F.when(free, F.struct(*place, "left", "weights"))).over(every)
    share = F.col("weight") * F.col("first.left") / (F.col("first.weights") * 100)
    cap = F.col("cap") / 100
    target = F.when(F.col("first").isNull(), cap).otherwise(F.least(cap, share)).cast("double")
    return (
        listed.withColumn("first", first)
        .withColumn("target", F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(target))
        .withColumn("wanted", F.floor(F.col("target") + 0.5).cast("long"))
        .select("source", "source_size", "kind", "target", "wanted")
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    schedules: tuple[Schedule, ...] = CURRICULUM,
    percent: int = 150,
    most_epochs: int = 2,
    size: Column | None = None,
) -> DataFrame:
    """One row per row of `docs`: id_col, source, size, source_size, target, taken, positions, text_hash, start.

    `start` counts the words of the source before the document in the source's order. `positions`
    holds the training time of each reading of the document, an epoch after the other
    (empty if it is not read). The reading at which a source's demand ends may be cut, so `taken`,
    words read in all, adds up to the target to the nearest word. A null text has size 0 and is
    never read; a null source is a source. Order within a source is by the MD5 of the id, so
    reruns agree; rows with the same id are ordered by a hash of their text, and repeated rows
    alike in everything may swap places. An empty table gives no rows. `size` replaces the
    word count of the text. Other columns are left out.
    """
    count = word_count(quoted(text_col)) if size is None else size.cast("long")
    rows = written(
        docs.select(
            quoted(id_col).alias("doc"),
            quoted(source_col).alias("source"),
            count.alias("size"),
            F.md5(F.coalesce(quoted(id_col).cast("string"), F.lit("")).cast("binary")).alias("order"),
            F.xxhash64(quoted(text_col).cast("string")).alias("content"),
        ),
        "sizes",
    )
    n = rows.count()
    digits = 0
    while n > RANGE_ROWS * 16**digits:
        digits += 1
    rows = rows.withColumn("range", F.substring("order", 1, digits))
    ranges = written(rows.groupBy("source", "range").agg(F.sum("size").alias("range_size")), "ranges")
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    started = ranges.withColumn("range_start", F.coalesce(F.sum("range_size").over(before), F.lit(0)))
    sources = ranges.groupBy("source").agg(F.sum("range_size").alias("source_size"))
    plan = targets(sources, schedules, percent, most_epochs).withColumnRenamed("source", "of")
    started = started.withColumnsRenamed({"source": "of_ranges", "range": "of_range"})
    started = started.join(plan, F.col("of_ranges").eqNullSafe(F.col("of")))
    here = Window.partitionBy("source", "range").orderBy("order", "doc", "content")
    inside = F.coalesce(F.sum("size").over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = rows.withColumn("inside", inside).join(
        started, F.col("source").eqNullSafe(F.col("of_ranges")) & (F.col("range") == F.col("of_range"))
    )
    begin = F.col("range_start") + F.col("inside")
    reads, times = [], []
    for epoch in range(most_epochs):
        start = begin + F.col("source_size") * epoch
        taken = F.greatest(F.lit(0), F.least(F.col("size"), F.col("wanted") - start)).cast("long")
        share = start / F.when(F.col("wanted") > 0, F.col("wanted"))
        at = F.lit(None).cast("double")
        for kind, schedule in enumerate(schedules):
            at = F.when(F.col("kind") == kind, schedule.time_of(share)).otherwise(at)
        reads.append(taken)
        times.append(F.when(taken > 0, at))
    total = reads[0]
    for read in reads[1:]:
        total = total + read
    return placed.select(
        F.col("doc").alias(id_col),
        F.col("source").alias("source"),
        "size",
        "source_size",
        "target",
        total.alias("taken"),
        F.filter(F.array(*times), lambda x: x.isNotNull()).alias("positions"),
        F.col("content").alias("text_hash"),
        begin.cast("long").alias("start"),
    )


def _readings(mixed: DataFrame, id_col: str) -> DataFrame:
    readings = mixed.select(
        quoted(id_col).alias("doc"),
        "text_hash",
        "source",
        "size",
        "taken",
        "start",
        F.posexplode("positions").alias("epoch", "position"),
    )
    words = F.least(F.col("size"), F.col("taken") - F.col("size") * F.col("epoch"))
    return readings.withColumn("words", words)


def in_training_order(mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """A row per reading, range-sorted by position: id_col, source, start, epoch, words, position.

    Source and start tell the rows of `mix` apart that are read at all. Readings of one position,
    of several sources, are in order of their ids. No readings, no rows.
    """
    return _readings(mixed, id_col).select(
        F.col("doc").alias(id_col), "source", "start", "epoch", "words", "position"
    ).orderBy("position", id_col, "epoch")


def by_document(mixed: DataFrame, order: DataFrame) -> DataFrame:
    """The rows of `mix` with what the readings of `in_training_order` say of them.

    Adds readings (their number) and first_position (null if there is none), and `taken` is the sum
    of their words. Rows of `mixed` without readings stay.
    """
    read = order.groupBy(F.col("source").alias("of"), F.col("start").alias("at")).agg(
        F.sum("words").alias("words"), F.count(F.lit(1)).alias("readings"), F.min("position").alias("first_position")
    )
    same = F.col("source").eqNullSafe(F.col("of")) & (F.col("start") == F.col("at")) & (F.col("size") > 0)
    joined = mixed.join(read, same, "left").drop("of", "at")
    found = {new: F.coalesce(old, F.lit(0)).cast("long") for new, old in (("taken", "words"), ("readings", "readings"))}
    return joined.withColumns(found).drop("words")


def mixed_documents(
    docs: DataFrame,
    mixed: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length_col: str | None = None,
) -> DataFrame:
    """The rows of `docs`, with all their columns, as often as `mixed` reads them, in training order.

    A reading that is cut has the text up to the end of its last word, and its number of code
    points in `length_col`, if that is named. `mixed` is `mix` of the same `docs`. Rows repeated
    with one id and text are read as one row, as often as all of them. Null texts and those
    without words are never read. An empty table gives no rows.
    """
    text = quoted(text_col).cast("string")
    row = F.struct(*[quoted(c) for c in docs.columns]).alias("row")
    rows = docs.select(row, quoted(id_col).alias("id"), F.xxhash64(text).alias("hash"))
    key = (quoted(id_col).alias("doc"), F.col("text_hash"))
    repeated = mixed.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    if repeated.isEmpty():
        each = _readings(mixed, id_col)
    else:
        repeated = written(repeated, "repeated")
        same = F.col("id").eqNullSafe(F.col("doc")) & (F.col("hash") == F.col("text_hash"))
        one = rows.join(repeated, same, "left_semi").groupBy("id", "hash").agg(F.first("row").alias("row"))
        rows = rows.join(repeated, same, "left_anti").unionByName(one)
        together = mixed.groupBy(*key).agg(
            F.first("source").alias("source"),
            F.first("size").alias("size"),
            F.sum("taken").alias("taken"),
            F.min("start").alias("start"),
            F.flatten(F.collect_list("positions")).alias("positions"),
        )
        each = _readings(together, "doc")
    each = each.select("doc", "text_hash", "size", "words", "position", "epoch")
    same = F.col("id").eqNullSafe(F.col("doc")) & (F.col("hash") == F.col("text_hash"))
    joined = rows.join(each, same)
    whole = F.col("row").getField(text_col).cast("string")
    pieces = F.regexp_extract_all(whole, F.lit(f"[{SPACES}]*{WORD}"), F.lit(0))
    short = F.array_join(F.slice(pieces, F.lit(1), F.col("words").cast("int")), "")
    cut = {text_col: short}
    if length_col:
        cut[length_col] = F.char_length(short).cast(docs.schema[length_col].dataType)
    columns = []
    for name in docs.columns:
        value = F.col("row").getField(name)
        if name in cut:
            value = F.when(F.col("words") < F.col("size"), cut[name]).otherwise(value)
        columns.append(value.alias(name))
    ordered = joined.orderBy("position", "doc", "epoch")
    return ordered.select(*columns)
