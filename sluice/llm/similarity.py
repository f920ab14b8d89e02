"""Exact joins of texts by the Jaccard similarity of their word shingles, with signature trees.

Texts with equal sets of shingles are one item from the start. Then:

1. *Shared shingles.* Of two linked sets the least of the common shingles are among the least of
   either, by hash. Each set deals those (half of it, for 75 %) to buckets of bounded size, which
   find those that other sets have dealt; a set with too few of them has no link. A task merges
   what it has read before it sends it, so a shingle of a third of all texts takes one entry per
   chunk. This test only lets through too much, never too little.
2. *Blocks.* Of the sets left, shingles are ordered by the number of sets that have them. Two
   linked sets share one of the first few (a quarter, for 75 %). Sets that share one of those are
   in one block, by connected components; no link leaves a block.
3. *Trees.* In each block a signature tree is traversed with itself. A block of more than
   `BLOCK_SETS` sets is dealt to several tasks: first each part is joined on its own, then one
   set of each group found, then those pairs of parts whose sets are not all joined yet.

Shingles and sets are known by 64-bit hashes. At a billion sets, one pair of unequal sets would
share its hash with a probability of about three in a hundred.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import bitmap, give_back, in_bitmap, quoted, ship, small, without, written
from sluice.llm.components import components
from sluice.llm import hashing
from sluice.llm.hashing import LOWER_BYTES, mixed, words
from sluice.llm.signature_tree import SignatureTree

#: Bytes of text hashed at once, and shingles merged before they are sent.
PIECE, CHUNK, LARGEST_CHUNK = 250_000, 500_000, 4_000_000
#: Shingles of a bucket, about.
BUCKET = 1_000_000
#: Per cent of a set that has to be among the shingles it deals and has in common with a linked one.
COUNTED = 25
#: Sets of a chunk, at most: numbers of two bytes, of which the last one is no set's.
NUMBERS = (1 << 16) - 1
#: Sets and shingles of a block that one task joins.
BLOCK_SETS, BLOCK_SHINGLES = 4000, 6_000_000
#: From so many sets on, a shingle counts as equally frequent.
FREQUENT = 255

_FACTORS = mixed(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def word_hashes(text: bytes) -> np.ndarray:
    """A hash of each word of a text, A-Z taken as a-z."""
    parts, start = [], 0
    while start < len(text):
        stop = start + PIECE
        if stop < len(text):
            while stop < len(text) and text[stop] not in b" \t\n\v\f\r":
                stop += 1
        data = np.frombuffer(text[start:stop], np.uint8)
        begin, end = words(data)
        parts.append(hashing.word_hashes(data, begin, end, LOWER_BYTES))
        start = stop
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def shingle_sets(texts: list[str | None], k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    waiting: list[bytes] = []
    held = 0
    for text in texts:
        data = (text or "").encode()
        if len(data) > PIECE:
            yield from _sets(waiting, k)
            waiting, held = [], 0
            yield from _of_words(word_hashes(data), np.zeros(1, np.int64), k)
            continue
        waiting.append(data)
        held += len(data)
        if held > PIECE:
            yield from _sets(waiting, k)
            waiting, held = [], 0
    yield from _sets(waiting, k)


def _sets(texts: list[bytes], k: int) -> Iterator[np.ndarray]:
    if not texts:
        return
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    begin, end = words(data)
    hashes = hashing.word_hashes(data, begin, end, LOWER_BYTES)
    text_at = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    yield from _of_words(hashes, np.searchsorted(begin, text_at), k)


def _of_words(hashes: np.ndarray, first: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """first: the place of each text's first word."""
    total = len(hashes)
    shingles = np.zeros(max(0, total - k + 1), np.uint64)
    for i in range(k):
        shingles += hashes[i : i + len(shingles)] * _FACTORS[i]
    shingles = mixed(shingles)
    for a, b in zip(first.tolist(), [*first[1:].tolist(), total]):
        if b - a >= k:
            own = np.sort(shingles[a : b - k + 1])
            yield own[np.append(True, own[1:] != own[:-1])]
        elif b > a:
            short = (hashes[a:b] * _FACTORS[: b - a]).sum(dtype=np.uint64, keepdims=True)
            yield mixed(short ^ np.array([b - a], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def set_hash(own: np.ndarray) -> int:
    """A signed 64-bit hash of a set."""
    total = mixed(own).sum(dtype=np.uint64, keepdims=True)
    return int(mixed(total ^ np.array([len(own)], np.uint64) * _FACTORS[7]).view(np.int64)[0])


def _chunks(
    batches: Iterator[pa.RecordBatch], k: int, shingles: int, most: int | None = None
) -> Iterator[dict[int, np.ndarray]]:
    """Distinct sets by hash, so many shingles or a little more at a time, of at most so many sets."""
    chunk: dict[int, np.ndarray] = {}
    held = 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            for own in shingle_sets(batch.column(0).slice(at, 256).to_pylist(), k):
                if len(own):
                    name = set_hash(own)
                    if name not in chunk:
                        chunk[name] = own
                        held += len(own)
                if held >= shingles or len(chunk) == most:
                    yield chunk
                    chunk, held = {}, 0
    if chunk:
        yield chunk
    del chunk
    give_back()


class Shingled:
    """The documents of one join and the tables that its steps share."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> None:
        if not 1 <= k <= len(_FACTORS) or not 1 <= percent <= 100:
            raise ValueError("k must be 1 to 64 and percent 1 to 100")
        ship(docs.sparkSession)
        self.k, self.percent = k, percent
        text = quoted(text_col).cast("string")
        self.rows = docs.select(quoted(id_col).alias("doc"), text.alias("text"), F.xxhash64(text).alias("content"))
        kind = docs.schema[id_col].dataType

        def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [(len(s), set_hash(s)) for s in shingle_sets(batch.column(1).to_pylist(), k)]
                columns = list(zip(*found)) or [(), ()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), *(pa.array(c, pa.int64()) for c in columns)],
                    ["doc", "content", "n", "item"],
                )
            give_back()

        fields = T._parse_datatype_string("content long, n long, item long").fields
        schema = T.StructType([T.StructField("doc", kind), *fields])
        #: doc, content (hash of the text), n (shingles), item (hash of the set); null if there is none.
        self.described = written(self.rows.mapInArrow(describe, schema), "described").withColumn(
            "item", F.when(F.col("n") > 0, F.col("item"))
        )

    def candidates(self) -> DataFrame:
        """Items enough of whose shingles occur in other items: item, n, content."""
        items = self.described.filter("n > 0").groupBy("item").agg(
            F.min("n").alias("n"), F.min("content").alias("content")
        )
        dealt = F.sum(F.col("n") - _ceil_share(F.col("n"), self.percent) + _ceil_share(F.col("n"), COUNTED))
        buckets = max(1, -(-(items.agg(dealt).first()[0] or 0) // BUCKET))
        k, percent = self.k, self.percent
        # with more buckets, larger chunks, so that a row holds some shingles
        size = min(LARGEST_CHUNK, max(CHUNK, 32 * buckets))

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number = TaskContext.get().partitionId() << 32
            for chunk in _chunks(batches, k, size, NUMBERS):
                yield from _dealt(chunk, number, buckets, percent)
                number += 1

        passing = (
            self.rows.select("text")
            .mapInArrow(deal, "bucket long, chunk long, entries binary")
            .groupBy("bucket")
            .applyInArrow(_shared, "bucket long, chunk long, entries binary")
            .groupBy("chunk")
            .applyInArrow(_passing(percent), "item long")
            .distinct()
        )
        return written(items.join(passing, "item"), "candidates")

    def blocks(self) -> DataFrame:
        """Items that may have links, with their sets and block: item, n, hashes, block."""
        found = self.candidates()
        total = found.agg(F.sum("n")).first()[0]
        chosen = found.select("content")
        maybe = self.rows.filter(in_bitmap(F.col("content"), bitmap(chosen)))
        texts = maybe.join(small(chosen), "content", "left_semi").select("text")
        buckets = max(1, -(-(total or 0) // BUCKET))
        k = self.k

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for chunk in _chunks(batches, k, CHUNK):
                yield _arrow(_ranges(chunk, buckets), _BUCKET)

        keyed = written(
            texts.mapInArrow(deal, "bucket long, entries binary")
            .groupBy("bucket")
            .applyInArrow(_ranker(buckets), "part long, bucket long, entries binary")
            .groupBy("part")
            .applyInArrow(
                _keyer(self.percent), "item long, n long, hashes binary, keys array<long>, near array<long>"
            ),
            "keyed",
        )
        # of the items of a part that share a key only the least goes on with it
        by_key = keyed.select("item", F.explode("keys").alias("key"))
        least = by_key.groupBy("key").agg(F.min("item").alias("b"), F.max("item").alias("other")).filter("b < other")
        edges = by_key.join(least.drop("other"), "key").select(F.col("item").alias("a"), "b").distinct()
        inside = keyed.select(F.col("item").alias("a"), F.explode("near").alias("b"))
        labels = components(edges.unionByName(inside))
        return keyed.select("item", "n", "hashes").join(
            labels.select(F.col("node").alias("item"), F.col("label").alias("block")), "item"
        )

    def links(self, spanning: bool) -> DataFrame:
        """Pairs (a, b) of linked items: all of them, or as many as join what is joined."""
        placed = written(self.blocks(), "placed")
        sizes = _sizes(placed)
        dealt = placed.join(sizes, "block").withColumn("part", F.pmod(F.xxhash64("item"), F.col("parts")))
        alone = F.xxhash64("block", "part")
        done = self._joined(dealt.withColumn("task", alone).withColumn("label", F.col("item")), spanning)
        done = written(done, "links")
        large = sizes.filter("parts > 1")
        if large.isEmpty():
            return done
        rest = dealt.filter("parts > 1")
        if spanning:
            leads = written(self._labelled(rest, done).filter("item = label").drop("parts", "part"), "leads")
            leads = leads.join(_sizes(leads), "block")
            task = F.xxhash64("block", F.lit("lead"), F.pmod(F.xxhash64("item"), F.col("parts")))
            more = self._joined(leads.withColumn("task", task), spanning)
            done = written(done.unionByName(more), "links")
            rest = written(self._labelled(rest, done), "labelled")
        else:
            rest = rest.withColumn("label", F.col("item"))
        of_part = rest.groupBy("block", "part").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        one, two = of_part.alias("x"), of_part.alias("y")
        apart = F.greatest("x.high", "y.high") != F.least("x.low", "y.low")
        of_block = (F.col("x.block") == F.col("y.block")) & (F.col("x.part") < F.col("y.part")) & apart
        pairs = one.join(two, of_block).select(
            F.col("x.block").alias("block"), F.col("x.part").alias("i"), F.col("y.part").alias("j")
        )
        task = F.xxhash64("block", "i", "j")
        first = pairs.select("block", F.col("i").alias("part"), F.lit(0).alias("side"), task.alias("task"))
        second = pairs.select("block", F.col("j").alias("part"), F.lit(1).alias("side"), task.alias("task"))
        sides = first.unionByName(second)
        across = self._joined(rest.join(sides, ["block", "part"]), spanning)
        return done.unionByName(across)

    @staticmethod
    def _labelled(rows: DataFrame, done: DataFrame) -> DataFrame:
        labels = components(done).withColumnRenamed("node", "item")
        return rows.drop("label").join(labels, "item", "left").withColumn("label", F.coalesce("label", "item"))

    def _joined(self, rows: DataFrame, spanning: bool) -> DataFrame:
        """Links within each task."""
        percent = self.percent
        if "side" not in rows.columns:
            rows = rows.withColumn("side", F.lit(None).cast("int"))

        def join(table: pa.Table) -> pa.Table:
            names = table["item"].to_numpy()
            if len(names) < 2:
                return _links([], names)
            sets = [np.frombuffer(h, np.uint64) for h in table["hashes"].to_pylist()]
            side = None if table["side"].null_count else table["side"].to_numpy()
            tree = SignatureTree(sets, percent, table["label"].to_numpy(), spanning, side)
            found = list(tree.links())
            del tree, sets
            give_back()
            return _links(found, names)

        of_task = rows.select("task", "item", "hashes", "label", "side").groupBy("task")
        return of_task.applyInArrow(join, "a long, b long")


_BUCKET = pa.schema([("bucket", pa.int64()), ("entries", pa.binary())])
_KEYED = pa.schema(
    [
        ("item", pa.int64()),
        ("n", pa.int64()),
        ("hashes", pa.binary()),
        ("keys", pa.list_(pa.int64())),
        ("near", pa.list_(pa.int64())),
    ]
)


def _sizes(placed: DataFrame) -> DataFrame:
    """Into how many parts each block is dealt: block, parts."""
    sizes = placed.groupBy("block").agg(F.count(F.lit(1)).alias("items"), F.sum("n").alias("shingles"))
    parts = F.greatest(F.ceil(F.col("items") / BLOCK_SETS), F.ceil(F.col("shingles") / BLOCK_SHINGLES))
    return sizes.select("block", parts.cast("long").alias("parts"))


def _arrow(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [() for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _links(found: list[tuple[int, int]], names: np.ndarray) -> pa.Table:
    one, two = names[np.array(found, np.int64).reshape(-1, 2)].T
    return pa.table({"a": np.minimum(one, two), "b": np.maximum(one, two)})


def _ceil_share(n: Column | np.ndarray | int, percent: int) -> Column | np.ndarray | int:
    """`percent` per cent of n, rounded up."""
    if isinstance(n, Column):
        return F.ceil(n * percent / 100)
    return -(-n * percent // 100)


_DEALT = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("entries", pa.binary())])


def _dealt(chunk: dict[int, np.ndarray], number: int, buckets: int, percent: int) -> Iterator[pa.RecordBatch]:
    """The least shingles of a chunk's sets by bucket, and who they are, under a bucket of their own.

    A set of n deals so many that what it lacks in a linked one, n less `percent` per cent of it,
    still leaves `COUNTED` per cent of n. So the least common shingles, that share of the smaller
    one of two linked sets, are among those that both deal. Shingles are told apart by 32 bits
    beside the bucket, which can only make more of them look shared. Those of several sets of the
    chunk are sent once, under the number `NUMBERS`; the sets that have them get the number of
    theirs at once. The entries of a bucket are the shingles, then the numbers of the sets.
    """
    names = np.fromiter(chunk, np.int64, len(chunk))
    sizes = np.array([len(own) for own in chunk.values()])
    dealt = np.minimum(sizes, sizes - _ceil_share(sizes, percent) + _ceil_share(sizes, COUNTED))
    values = np.concatenate([own[:n] for own, n in zip(chunk.values(), dealt.tolist())])
    owner = np.repeat(np.arange(len(names)), dealt)
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    start = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    length = np.diff(np.append(start, len(ranked)))
    # in order of their hashes: those of one set, and those of several, once
    several = length > 1
    local = np.bincount(owner[order[np.repeat(several, length)]], minlength=len(names)).astype(np.uint32)
    values = ranked[start]
    owner = np.where(several, NUMBERS, owner[order[start]]).astype(np.uint16)
    bucket = ((values & np.uint64(0xFFFFFFFF)) * np.uint64(buckets)) >> np.uint64(32)
    by_bucket = np.argsort(bucket, kind="stable")
    bucket, short, owner = bucket[by_bucket], (values >> np.uint64(32)).astype(np.uint32)[by_bucket], owner[by_bucket]
    cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket)).tolist()
    head = names.tobytes() + sizes.astype(np.uint32).tobytes() + local.tobytes()
    rows = [(-1 - number, number, head)]
    for a, b in zip(cuts, cuts[1:]):
        rows.append((int(bucket[a]), number, short[a:b].tobytes() + owner[a:b].tobytes()))
        if len(rows) >= 64:
            yield _arrow(rows, _DEALT)
            rows = []
    yield _arrow(rows, _DEALT)


def _shared(table: pa.Table) -> pa.Table:
    """Of a bucket, by chunk, the numbers of sets whose shingles occur in other chunks, once for each."""
    if table["bucket"][0].as_py() < 0:
        return table.select(_DEALT.names)
    chunks, shorts, owners = table["chunk"].to_pylist(), [], []
    for value in table["entries"].to_pylist():
        n = len(value) // 6
        shorts.append(np.frombuffer(value, np.uint32, n))
        owners.append(np.frombuffer(value, np.uint16, n, 4 * n))
    short, owner = np.concatenate(shorts), np.concatenate(owners)
    of = np.repeat(np.arange(len(chunks)), [len(x) for x in shorts])
    order = np.argsort(short, kind="stable")
    ranked = short[order]
    begin = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    length = np.diff(np.append(begin, len(ranked)))
    again = np.zeros(len(short), bool)
    again[order] = np.repeat(length > 1, length)
    again &= owner != NUMBERS
    cuts = np.searchsorted(of[again], np.arange(len(chunks) + 1)).tolist()
    owner = owner[again]
    rows = [
        (0, chunk, owner[a:b].tobytes()) for chunk, a, b in zip(chunks, cuts, cuts[1:]) if b > a
    ]
    del shorts, owners, short, of, order, ranked, again
    give_back()
    return pa.Table.from_batches([_arrow(rows, _DEALT)])


def _passing(percent: int):
    """The sets of a chunk that have enough of what they dealt in common with others."""

    def run(table: pa.Table) -> pa.Table:
        counts = np.zeros(NUMBERS + 1, np.int64)
        names = sizes = np.zeros(0, np.int64)
        for bucket, value in zip(table["bucket"].to_pylist(), table["entries"].to_pylist()):
            if bucket < 0:
                n = len(value) // 16
                names = np.frombuffer(value, np.int64, n)
                sizes = np.frombuffer(value, np.uint32, n, 8 * n).astype(np.int64)
                counts[:n] += np.frombuffer(value, np.uint32, n, 12 * n)
            else:
                counts += np.bincount(np.frombuffer(value, np.uint16), minlength=len(counts))
        # a linked set may be as small as this one's share, and deal that much less
        wanted = _ceil_share(_ceil_share(sizes, percent), COUNTED)
        return pa.table({"item": pa.array(names[counts[: len(names)] >= wanted], pa.int64())})

    return run


def _parts(names: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Items sorted by part, and where each part starts."""
    part = ((names.view(np.uint64) >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    order = np.argsort(part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(parts + 1))


def _entries(names: np.ndarray, sizes: np.ndarray, *values: np.ndarray) -> bytes:
    """Items, the number of their shingles, and the shingles by item with what belongs to them."""
    head = np.array([len(names)], np.uint64)
    return b"".join(x.tobytes() for x in (head, names.astype(np.int64), sizes.astype(np.int64), *values))


def _read_entries(value: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n = int(np.frombuffer(value, np.uint64, 1)[0])
    names, sizes = np.frombuffer(value, np.int64, n, 8), np.frombuffer(value, np.int64, n, 8 + 8 * n)
    total = int(sizes.sum())
    return (
        names,
        sizes,
        np.frombuffer(value, np.uint64, total, 8 + 16 * n),
        np.frombuffer(value, np.uint8, offset=8 + 16 * n + 8 * total),
    )


def _ranges(chunk: dict[int, np.ndarray], buckets: int) -> list[tuple[int, bytes]]:
    """The sets of a chunk cut into ranges of hashes, a bucket each.

    A shingle that `FREQUENT` or more sets of the chunk have is known to be that frequent. Its
    bucket is told once, under the item -1 in place of all that have it; where they are needed
    these entries go to the parts of their items at once, under the numbers after the buckets.
    """
    names = np.fromiter(chunk, np.int64, len(chunk))
    sizes = np.array([len(own) for own in chunk.values()])
    values = np.concatenate(list(chunk.values()))
    owner = np.repeat(np.arange(len(names)), sizes)
    _, which, count = np.unique(values, return_inverse=True, return_counts=True)
    frequent = count[which] >= FREQUENT
    part = ((names.view(np.uint64) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    bucket = ((values >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    target = np.where(frequent, np.uint64(buckets) + part[owner], bucket).astype(np.int64)
    order = np.argsort(target, kind="stable")  # within a target still by item, and sorted
    told = np.unique(values[frequent])
    told_at = (((told >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
    rows = []
    cuts = np.searchsorted(target[order], np.arange(2 * buckets + 1))
    for b in range(2 * buckets):
        at = order[cuts[b] : cuts[b + 1]]
        own, more = owner[at], told[told_at == b]
        if len(at) or len(more):
            first = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(at) else np.zeros(0, np.int64)
            length = np.diff(np.append(first, len(own)))
            some, here = names[own[first]], values[at]
            if len(more):
                some, length, here = np.append(some, -1), np.append(length, len(more)), np.append(here, more)
            rows.append((b, _entries(some, length, here)))
    return rows


def _ranker(parts: int):
    """Adds to the shingles of a bucket the number of items that have them, `FREQUENT` at most; by part."""

    schema = pa.schema([("part", pa.int64()), ("bucket", pa.int64()), ("entries", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        read = [_read_entries(value) for value in table["entries"].to_pylist()]
        names, sizes = np.concatenate([r[0] for r in read]), np.concatenate([r[1] for r in read])
        values = np.concatenate([r[2] for r in read])
        owner = np.repeat(np.arange(len(names)), sizes)
        told = np.unique(values[names[owner] == -1])
        # copies of one item from several chunks are one
        order = np.lexsort((names[owner], values))
        v, i = values[order], names[owner[order]]
        order = order[np.append(True, (v[1:] != v[:-1]) | (i[1:] != i[:-1])) & (i != -1)]
        if not len(order):
            return pa.Table.from_batches([_arrow([], schema)])
        _, which, count = np.unique(values[order], return_inverse=True, return_counts=True)
        frequency = np.minimum(count, FREQUENT)[which]
        frequency[np.isin(values[order], told) | (bucket >= parts)] = FREQUENT
        # by item again, the shingles in order
        by_item = np.lexsort((values[order], names[owner[order]]))
        order, frequency = order[by_item], frequency[by_item].astype(np.uint8)
        values, item = values[order], names[owner[order]]
        first = np.flatnonzero(np.append(True, item[1:] != item[:-1]))
        names, sizes = item[first], np.diff(np.append(first, len(item)))
        start = np.cumsum(sizes) - sizes
        order, cuts = _parts(names, parts)
        rows = []
        for p in range(parts):
            at = order[cuts[p] : cuts[p + 1]]
            if len(at):
                shift = start[at] - (np.cumsum(sizes[at]) - sizes[at])
                places = np.repeat(shift, sizes[at]) + np.arange(sizes[at].sum())
                rows.append((p, bucket, _entries(names[at], sizes[at], values[places], frequency[places])))
        out = _arrow(rows, schema)
        del read, values, owner, order, frequency, item, rows
        give_back()
        return pa.Table.from_batches([out])

    return run


def _keyer(percent: int):
    """The whole sets of a part's items and, of their rarest shingles, their keys.

    Items of a part that share a key: the least keeps it, the others are near the least.
    """

    def run(table: pa.Table) -> pa.Table:
        read = [_read_entries(value) for value in table["entries"].to_pylist()]
        names, sizes = np.concatenate([r[0] for r in read]), np.concatenate([r[1] for r in read])
        values, frequency = np.concatenate([r[2] for r in read]), np.concatenate([r[3] for r in read])
        # a shingle of an item may come straight from a chunk and by its bucket: both say the same
        item = np.repeat(names, sizes)
        order = np.lexsort((values, item))
        v, i = values[order], item[order]
        order = order[np.append(True, (v[1:] != v[:-1]) | (i[1:] != i[:-1]))]
        values, frequency, item = values[order], frequency[order], item[order]
        begin = np.flatnonzero(np.append(True, item[1:] != item[:-1]))
        found, keys = [], []
        for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(item)]):
            own, seen, n = values[a:b], frequency[a:b], b - a
            rare = np.argsort(seen, kind="stable")[: n - -(-percent * n // 100) + 1]
            mine = own[rare[seen[rare] > 1]]
            if len(mine):
                found.append((int(item[a]), own))
                keys.append(mine)
        if not found:
            return pa.Table.from_batches([_arrow([], _KEYED)])
        of = np.repeat(np.array([name for name, _ in found], np.int64), [len(k) for k in keys])
        row = np.repeat(np.arange(len(found)), [len(k) for k in keys])
        every = np.concatenate(keys)
        order = np.lexsort((of, every))
        first = np.append(True, every[order][1:] != every[order][:-1])
        least = of[order][np.flatnonzero(first)][np.cumsum(first) - 1]
        goes_on: list[list[int]] = [[] for _ in found]
        near: list[set[int]] = [set() for _ in found]
        for r, key, is_first, low in zip(
            row[order].tolist(), every[order].view(np.int64).tolist(), first.tolist(), least.tolist()
        ):
            if is_first:
                goes_on[r].append(key)
            else:
                near[r].add(low)
        rows = [
            (name, len(own), own.tobytes(), goes_on[r], sorted(near[r])) for r, (name, own) in enumerate(found)
        ]
        return pa.Table.from_batches([_arrow(rows, _KEYED)])

    return run


def similar_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 75
) -> DataFrame:
    """One row per row of `docs`: id_col, n_shingles, component_id.

    Words are runs of other characters than white space, A-Z as a-z; a text's set are its distinct
    shingles of k words, or all its words as one if it has fewer. Texts are linked if their sets'
    intersection is at least `percent` % of their union. component_id is the least id that links
    lead to; null ids are passed over, unless there are no others. Texts that are null or without
    words have an empty set and are linked with nothing. Repeated rows are linked with each other.
    An empty table gives no rows; other columns are left out.
    """
    rows = _grouped(docs, id_col, text_col, k, percent)
    least = rows.groupBy("group").agg(F.min("doc").alias("least"), F.count(F.lit(1)).alias("size"))
    several = written(least.filter("group IS NOT NULL AND size > 1").select("group", "least"), "several")
    joined = rows.join(small(several), "group", "left")
    return joined.select(
        F.col("doc").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.coalesce("least", "doc").alias("component_id"),
    )


def _grouped(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """doc, content, n and group of each row; the group is null for empty sets."""
    join = Shingled(docs, id_col, text_col, k, percent)
    labels = components(join.links(spanning=True)).withColumnRenamed("node", "item")
    return join.described.join(small(written(labels, "labels")), "item", "left").select(
        "doc", "content", "n", F.coalesce("label", "item").alias("group")
    )


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 75
) -> DataFrame:
    """The rows of `docs`, with all their columns, without the linked copies of the first of a group.

    The row with the least id stays (a null id only if all are null; then the least hash of the
    text). Rows without words, null texts too, stay. Rows repeated with one id and text stay or go
    together. An empty table gives no rows.
    """
    rows = written(_grouped(docs, id_col, text_col, k, percent).filter("group IS NOT NULL"), "grouped")
    best = F.min(F.struct(F.col("doc").isNull().alias("no_id"), "doc", "content")).alias("best")
    several = rows.groupBy("group").agg(best, F.count(F.lit(1)).alias("size")).filter("size > 1")
    stays = F.col("doc").eqNullSafe(F.col("best.doc")) & (F.col("content") == F.col("best.content"))
    several = small(written(several, "several"))
    gone = rows.join(several, "group").filter(~stays).select("doc", "content").distinct()
    return without(docs, gone, id_col, text_col)


def similar_pairs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 75
) -> tuple[DataFrame, DataFrame]:
    """All links between different sets, and who has them.

    The first table has a row per linked pair of sets, as ids (a, b) of their first documents; the
    second a row per document: id_col, n_shingles, and `set_id`, the least id with an equal set
    (null for empty sets). Copies are not expanded into pairs. Null ids are passed over as in
    `similar_components`. An empty table gives two empty ones; other columns are left out.
    """
    join = Shingled(docs, id_col, text_col, k, percent)
    first = join.described.filter("item IS NOT NULL").groupBy("item").agg(F.min("doc").alias("set_id"))
    member = join.described.join(first, "item", "left").select(
        F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), "set_id"
    )
    links = join.links(spanning=False)
    for side in ("a", "b"):
        links = links.join(first.select(F.col("item").alias(side), F.col("set_id").alias(f"{side}_id")), side)
    return links.select(F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b")), member
