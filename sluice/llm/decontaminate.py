"""Benchmark decontamination: a prefix-filtered join of item windows with documents.

A window of a benchmark item is some consecutive words of it; an item with fewer words is one
window. A document holds a window where the same words stand one after the other.

1. The windows, each once, are cut into shingles of a few words. A window shorter than a shingle is
   one shingle of its own length.
2. One scan of the documents tests their shingles against a bitmap of the windows' shingles. The
   bitmap has at most `BITS` bits, however many windows there are. Only runs of consecutive shingles
   that all pass and are long enough for a window (the length bound) leave the scan.
3. Shingles are counted over the runs of all documents. The rarest one of a window is its prefix: all
   shingles of a window have to occur, so one is enough, and the rarest gives the fewest candidates.
4. Runs are joined with windows on the prefix. Where it stands in the window gives the only place
   where the window can begin; it has to lie within the run (the positional bound).
5. There the words are compared.

Nothing depends on the hashes but the number of candidates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import give_back, quoted, ship, written
from sluice.llm.hashing import LOWER_BYTES, mixed, running, stretches, words

#: A word, in Java patterns, once A-Z are a-z.
ITEM_WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BYTES = np.arange(256)
#: Bytes that part words; those of characters beyond ASCII do not.
_PARTS = ~(
    (_BYTES >= 0x80) | ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | np.isin(_BYTES, list((_UPPER + _LOWER).encode()))
)
#: Bits of the bitmap, at most (16 MB), and for each shingle.
BITS, BITS_PER_SHINGLE = 1 << 27, 64
#: Bits of a bitmap row.
_BLOCK_BITS = 1 << 16
#: Bytes of text hashed at once.
PIECE = 1 << 20

_FACTORS = mixed(np.arange(101, 165, dtype=np.uint64)) | np.uint64(1)


def word_list(text: Column) -> Column:
    """The words of a text, A-Z taken as a-z; null has none."""
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)
    return F.regexp_extract_all(lower, F.lit(ITEM_WORD), F.lit(0))


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    shingle: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per row of `docs`: id_col, n_words, spans, items.

    `spans` holds the stretches of words inside any occurrence of a window, as (start, end) in word
    numbers, joined where they overlap or touch; `items` the ids, as strings in order, of the items
    with an occurring window. Both are empty for clean documents. Null and empty texts have no words;
    an item without words has no window. An item's null id lists no item, but its windows count for spans.
    Repeated rows of a document each get their row, repeated items count once. Either table may be
    empty. Other columns are left out.
    """
    if not 2 <= shingle <= window or window > len(_FACTORS):
        raise ValueError(f"shingle must be 2 to window, and window at most {len(_FACTORS)}")
    spark = docs.sparkSession
    ship(spark)
    windows, holders = _windows(benchmark, window, shingle, item_col, item_text_col)
    runs = _runs(docs, windows, shingle, id_col, text_col)
    found = _occurrences(runs, windows)
    spans = _joined(found).groupBy("row").agg(F.sort_array(F.collect_list("span")).alias("spans"))
    items = found.select("row", "name").distinct().join(holders, "name").select("row", "item").distinct()
    items = items.groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items"))
    hits = written(spans.join(items, "row", "left"), "hits")
    # only documents with a run are joined
    doc = [F.col("doc").alias(id_col), "n_words"]
    none = [F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"),
            F.array().cast("array<string>").alias("items")]
    clean = runs.filter("size(runs) = 0").select(*doc, *none)
    rest = runs.filter("size(runs) > 0").select("row", *doc).join(hits, "row", "left")
    rest = rest.withColumns({"spans": F.coalesce("spans", none[0]), "items": F.coalesce("items", none[1])})
    return clean.unionByName(rest.drop("row"))


def words_inside(spans: Column) -> Column:
    """The number of words in the spans of `benchmark_hits`."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, span: n + span["end"] - span["start"])


def decontaminated(docs: DataFrame, benchmark: DataFrame, most: float = 0.0, **options) -> DataFrame:
    """The ids, n_words, spans and items of documents with at most this share of words inside windows."""
    hits = benchmark_hits(docs, benchmark, **options)
    return hits.filter(words_inside(F.col("spans")) <= F.lit(most) * F.col("n_words"))


def _windows(
    benchmark: DataFrame, window: int, shingle: int, item_col: str, text_col: str
) -> tuple[DataFrame, DataFrame]:
    """The distinct windows (name, words, size of their shingles), and (name, item)."""
    items = benchmark.select(quoted(item_col).cast("string").alias("item"), word_list(quoted(text_col)).alias("all"))
    items = items.filter("size(all) > 0").withColumn("length", F.least(F.size("all"), F.lit(window)))
    cut = F.transform(
        F.sequence(F.lit(1), F.size("all") - F.col("length") + 1), lambda i: F.slice("all", i, F.col("length"))
    )
    pairs = written(items.select("item", F.explode(cut).alias("words")).distinct(), "windows")
    named = pairs.select("words").distinct().select(
        F.monotonically_increasing_id().alias("name"), "words", F.least(F.size("words"), F.lit(shingle)).alias("size")
    )
    named = written(named, "named")
    holders = pairs.filter("item is not null").join(named, "words").select("name", "item")
    return named, written(holders, "holders")


# -- the scan ----------------------------------------------------------------------------------


def _word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word the first byte, the byte after the last, and a hash; a piece at a time."""
    found, start = [], 0
    while start < len(text):
        stop = start + PIECE
        while stop < len(text) and not _PARTS[text[stop]]:
            stop += 1
        data = np.frombuffer(text[start:stop], np.uint8)
        begin, end = words(data, _PARTS)
        found.append((begin + start, end + start, stretches(running(data, LOWER_BYTES), begin, end)))
        start = stop
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(part) for part in zip(*found))


def _shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    out = np.full(max(0, len(hashes) - size + 1), size, np.uint64)
    for i in range(size):
        out += hashes[i : i + len(out)] * _FACTORS[i]
    return mixed(out)


class ShingleFilter:
    """A bitmap of the shingles of all windows, and the lengths that the windows have."""

    def __init__(self, bits: np.ndarray, shift: int, shingle: int, shortest: dict[int, int]) -> None:
        self.bits, self.shift, self.shingle = bits, np.uint64(shift), shingle
        #: Shingle size to the least number of words of a window with such shingles.
        self.shortest = shortest

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes >> self.shift
        return (self.bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def runs(self, texts: list[bytes]) -> Iterator[tuple[int, list[dict]]]:
        """The number of words of each text, and its runs: size of the shingles, first word, text."""
        data = b"\n".join(texts)
        begin, end, hashes = _word_hashes(data)
        edges = np.cumsum([0] + [len(t) + 1 for t in texts])
        first = np.searchsorted(begin, edges)
        after = np.repeat(first[1:], np.diff(first))  # of each word, the first one of the next text
        found: list[tuple[int, int, int]] = []
        for size, shortest in self.shortest.items():
            inside = self.holds(_shingle_hashes(hashes, size))
            inside &= np.arange(size, len(inside) + size) <= after[: len(inside)]
            if size < self.shingle:  # each one is a window
                starts = np.flatnonzero(inside)
                found.extend(zip([size] * len(starts), starts.tolist(), (starts + size).tolist()))
                continue
            edge = np.flatnonzero(np.diff(np.concatenate([[0], inside.view(np.int8), [0]])))
            starts, ends = edge[::2], edge[1::2] + size - 1
            long = ends - starts >= shortest
            found.extend(zip([size] * int(long.sum()), starts[long].tolist(), ends[long].tolist()))
        of_text: dict[int, list[dict]] = {}
        for size, a, b in found:
            at = int(np.searchsorted(first, a, "right")) - 1
            run = {"size": size, "start": a - int(first[at]), "text": data[begin[a] : end[b - 1]].decode()}
            of_text.setdefault(at, []).append(run)
        for at, n in enumerate(np.diff(first).tolist()):
            yield n, of_text.get(at, [])


def _filter(windows: DataFrame, shingle: int) -> ShingleFilter:
    """At most `BITS` bits come to the driver, and a row for each length of a window."""
    lengths = windows.groupBy("size", F.size("words").alias("length")).agg(F.count(F.lit(1)).alias("n")).collect()
    shortest: dict[int, int] = {}
    for row in lengths:
        shortest[row.size] = min(row.length, shortest.get(row.size, row.length))
    count = sum(row.n * (row.length - row.size + 1) for row in lengths)
    bits = min(BITS, max(_BLOCK_BITS, 1 << (count * BITS_PER_SHINGLE).bit_length()))
    shift = 64 - bits.bit_length() + 1

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros(0, np.uint64)]
            for text, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found.append(_shingle_hashes(_word_hashes(text.encode())[2], size))
            slot = np.unique(np.concatenate(found) >> np.uint64(shift)).astype(np.int64)
            columns = [pa.array(slot // _BLOCK_BITS), pa.array(slot % _BLOCK_BITS)]
            yield pa.RecordBatch.from_arrays(columns, ["block", "bit"])

    def packed(key, table):
        flags = np.zeros(_BLOCK_BITS, bool)
        flags[table.column("bit").to_numpy()] = True
        bits = np.packbits(flags, bitorder="little").tobytes()
        return pa.table({"block": [key[0].as_py()], "bits": pa.array([bits], pa.binary())})

    texts = windows.select(F.array_join("words", " ").alias("text"), "size")
    blocks = texts.mapInArrow(slots, "block long, bit long").distinct()
    out = np.zeros(bits // 8, np.uint8)
    for row in blocks.groupBy("block").applyInArrow(packed, "block long, bits binary").toLocalIterator():
        out[row.block * _BLOCK_BITS // 8 :][: _BLOCK_BITS // 8] = np.frombuffer(row.bits, np.uint8)
    return ShingleFilter(out, shift, shingle, shortest)


_RUN = T.StructType().add("size", T.IntegerType()).add("start", T.LongType()).add("text", T.StringType())


def _runs(docs: DataFrame, windows: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """Written rows (row, doc, n_words, runs); `row` tells the rows of `docs` apart."""
    passing = docs.sparkSession.sparkContext.broadcast(_filter(windows, shingle))
    runs_type = pa.list_(pa.struct({"size": pa.int32(), "start": pa.int64(), "text": pa.string()}))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tested = passing.value
        for batch in batches:
            counts, runs, group, held = [], [], [], 0

            def take() -> None:
                for n, own in tested.runs(group):
                    counts.append(n)
                    runs.append(own)

            for text in batch.column(1):
                data = (text.as_py() or "").encode()
                if group and held + len(data) > PIECE:
                    take()
                    group, held = [], 0
                group.append(data)
                held += len(data)
            if group:
                take()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(runs, runs_type)], ["doc", "n_words", "runs"]
            )
        give_back()

    rows = docs.select(quoted(id_col).alias("doc"), quoted(text_col).cast("string").alias("text"))
    schema = T.StructType().add("doc", docs.schema[id_col].dataType).add("n_words", T.LongType())
    schema = schema.add("runs", T.ArrayType(_RUN))
    found = rows.mapInArrow(scan, schema).withColumn("row", F.monotonically_increasing_id())
    return written(found, "runs")


# -- the join ----------------------------------------------------------------------------------


def _shingles(size: str = "size") -> Column:
    """An array of the hashes of the shingles of the column words."""
    places = F.sequence(F.lit(1), F.size("words") - F.col(size) + 1)
    return F.transform(places, lambda i: F.xxhash64(F.slice("words", i, F.col(size))))


def _occurrences(runs: DataFrame, windows: DataFrame) -> DataFrame:
    """Written rows (row, start, end, name): the words of the document that are the window."""
    run = runs.filter("size(runs) > 0").select("row", F.posexplode("runs").alias("run", "of"))
    run = run.select("row", "run", "of.size", "of.start", word_list(F.col("of.text")).alias("words"))
    shingles = run.select("row", "run", "start", (F.col("start") + F.size("words")).alias("stop"),
                          F.posexplode(_shingles()).alias("at", "hash"))
    counts = shingles.groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    own = windows.select("name", F.posexplode(_shingles()).alias("offset", "hash"))
    rarest = own.join(counts, "hash", "left").groupBy("name")
    rarest = rarest.agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "hash", "offset")).alias("prefix"))
    prefixes = rarest.filter("prefix.n > 0").join(windows, "name")
    prefixes = prefixes.select("name", "prefix.hash", "prefix.offset", F.col("words").alias("window"))
    prefixes = written(prefixes, "prefix")
    begin = F.col("start") + F.col("at") - F.col("offset")
    candidates = shingles.join(prefixes, "hash").withColumn("begin", begin)
    past = F.col("begin") + F.size("window")
    candidates = candidates.filter((F.col("begin") >= F.col("start")) & (past <= F.col("stop")))
    # the candidates of a run meet it once, whatever its length
    candidate = F.struct("begin", "name", "window").alias("candidate")
    listed = candidates.groupBy("row", "run").agg(F.collect_list(candidate).alias("candidates"))
    same = F.filter(
        "candidates",
        lambda c: F.slice("words", (c["begin"] - F.col("start") + 1).cast("int"), F.size(c["window"])) == c["window"],
    )
    confirmed = run.join(listed, ["row", "run"]).select("row", F.explode(same).alias("c"))
    end = F.col("c.begin") + F.size("c.window")
    places = F.col("c.begin").alias("start"), end.alias("end"), F.col("c.name").alias("name")
    return written(confirmed.select("row", *places), "found")


def _joined(found: DataFrame) -> DataFrame:
    """Rows (row, span): occurrences of a document that overlap or touch as one span."""
    places = found.select("row", "start", "end").distinct()
    before = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)
    fresh = F.coalesce((F.col("start") > F.max("end").over(before)).cast("int"), F.lit(1))
    spans = places.withColumn("fresh", fresh).withColumn("island", F.sum("fresh").over(upto))
    spans = spans.groupBy("row", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return spans.select("row", F.struct("start", "end").alias("span"))
