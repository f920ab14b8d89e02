"""Vector code compression: a byte or so for each part of a vector, by codebooks fitted on all rows.

1. The vectors become integers and are dealt into blocks as they are read. For each block and part
   an anchors-hierarchy metric tree is built (`metric_tree.py`), whose balls cache sums and counts.
   Blocks and trees are written once to the shared folder.
2. Each round reads them: every task sends its blocks' balls down the lists of candidate entries
   and adds up sums and counts per part and entry; a grouping adds up the tasks'. Only those come
   to the driver, parts times entries rows, whatever the number of vectors.
3. A last pass assigns the codes.

All arithmetic that decides a result is on integers, so partitions and order do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import give_back, quoted, ship, small, written
from sluice.llm.metric_tree import BallTree, ball_tree, nearest_entries

#: Vectors of a block.
BLOCK_ROWS = 16384
#: Integers must be smaller than this, so that sums of squares of a part stay exact.
LARGEST = 1 << 26

_TREE = [f.name for f in fields(BallTree)]
_KINDS = dict(zip(_TREE, ("<i4", "<i4", "<i4", "<i4", "<i4", "<f8", "<i8")))


@dataclass(frozen=True)
class Codebooks:
    """Entries by part, entry and position in the part."""

    entries: np.ndarray

    def sha256(self) -> str:
        """Of all integers in decimal, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def decoded(self, codes: np.ndarray) -> np.ndarray:
        """The integer vectors that rows of codes stand for."""
        return np.concatenate([self.entries[p][codes[:, p]] for p in range(len(self.entries))], axis=1)


class VectorBlocks:
    """The integer vectors of a table with the trees of their parts, written to the shared folder.

    Rows whose vector is null or holds null or non-finite components are left out. All other
    vectors must have one length, a multiple of `parts`, and integers floor(scale * x) below
    `LARGEST`; else ValueError. Null ids and repeated rows are kept, an empty table has no blocks.
    """

    def __init__(
        self, vectors: DataFrame, parts: int, scale: int, id_col: str, vec_col: str, label_col: str | None
    ) -> None:
        ship(vectors.sparkSession)
        self.parts, self.scale = parts, scale
        vec = quoted(vec_col).cast("array<double>")
        label = quoted(label_col) if label_col else F.lit(None).cast("int")
        rows = vectors.select(quoted(id_col).alias("id"), label.alias("label"), vec.alias("vec"))
        finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        self.usable = rows.filter(F.col("vec").isNotNull() & finite)
        shape = self.usable.agg(F.min(F.size("vec")), F.max(F.size("vec"))).first()
        self.dims = shape[0] or 0
        if shape[0] is not None and (shape[0] != shape[1] or not self.dims or self.dims % parts):
            raise ValueError(f"vectors have {shape[0]} to {shape[1]} components; all need a multiple of {parts}")
        self.id_type, self.label_type = rows.schema["id"].dataType, rows.schema["label"].dataType
        self.blocks = written(self._blocks(), "vector-blocks") if self.dims else None

    def _blocks(self) -> DataFrame:
        parts, scale = self.parts, self.scale
        schema = T.StructType().add("ids", T.ArrayType(self.id_type)).add("labels", T.ArrayType(self.label_type))
        schema = schema.add("points", T.BinaryType())
        for name in _TREE:
            schema = schema.add(name, T.ArrayType(T.BinaryType()))

        def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []
            count = 0
            for batch in batches:
                while batch.num_rows:
                    some = batch.slice(0, BLOCK_ROWS - count)
                    batch = batch.slice(some.num_rows)
                    held.append(some)
                    count += some.num_rows
                    if count == BLOCK_ROWS:
                        yield _block(pa.Table.from_batches(held), parts, scale)
                        held, count = [], 0
            if count:
                yield _block(pa.Table.from_batches(held), parts, scale)
            give_back()

        return self.usable.mapInArrow(gather, schema)

    def first(self, count: int) -> Codebooks:
        """The vectors of the smallest ids, nulls last, as entries."""
        rows = self.usable.orderBy(F.col("id").asc_nulls_last(), "vec").limit(count).select("vec").collect()
        points = _integers(np.array([r.vec for r in rows], np.float64), self.scale)
        return Codebooks(np.stack(np.split(points, self.parts, axis=1)))

    def improved(self, books: Codebooks) -> Codebooks:
        """Each entry replaced by the floor of the mean of the parts nearest to it, if there are any."""
        parts, shape = self.parts, books.entries.shape
        sent = self.blocks.sparkSession.sparkContext.broadcast(books.entries)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            entries = sent.value
            counts = np.zeros(shape[:2], np.int64)
            totals = np.zeros(shape, np.int64)
            for points, trees, _ in _blocks_of(batches, parts):
                for p in range(parts):
                    found = nearest_entries(points[p], trees[p], entries[p])
                    counts[p] += found.counts
                    totals[p] += found.totals
            used = np.argwhere(counts > 0)
            rows = [
                {"part": p, "entry": e, "n": int(counts[p, e]), "total": totals[p, e].tolist()}
                for p, e in used.tolist()
            ]
            yield pa.RecordBatch.from_pylist(rows, _SUMS)
            give_back()

        sums = self.blocks.mapInArrow(add, "part int, entry int, n long, total array<long>")
        sums = sums.select("part", "entry", "n", F.posexplode("total").alias("at", "value"))
        sums = sums.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("value").alias("value"))
        better = books.entries.copy()
        for row in sums.collect():  # at most as many as the codebooks have integers
            better[row.part, row.entry, row.at] = row.value // row.n
        return Codebooks(better)

    def codes(self, books: Codebooks) -> DataFrame:
        """Rows (id, label, code, error): an array of entry numbers and the squared distance."""
        parts = self.parts
        sent = self.blocks.sparkSession.sparkContext.broadcast(books.entries)
        schema = T.StructType().add("id", self.id_type).add("label", self.label_type)
        schema = schema.add("code", T.ArrayType(T.IntegerType())).add("error", T.LongType())

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            entries = sent.value
            for points, trees, row in _blocks_of(batches, parts):
                codes = np.empty((len(row["ids"]), parts), np.int32)
                error = np.zeros(len(codes), np.int64)
                for p in range(parts):
                    codes[:, p] = nearest_entries(points[p], trees[p], entries[p]).nearest
                    error += ((points[p] - entries[p][codes[:, p]]) ** 2).sum(axis=1)
                ends = np.arange(0, codes.size + 1, parts, dtype=np.int32)
                columns = [row["ids"].values, row["labels"].values,
                           pa.ListArray.from_arrays(pa.array(ends), pa.array(codes.ravel())), pa.array(error)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "label", "code", "error"])
            give_back()

        return self.blocks.mapInArrow(assign, schema)


def compress(
    vectors: DataFrame,
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    scale: int = 256,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str | None = "label",
) -> tuple[DataFrame, Codebooks]:
    """Rows (id_col, label, code, error, label_error), and the codebooks.

    Each component x is floor(scale * x), each vector is cut into equal parts. A part's codebook
    starts as that part of the vectors with the smallest ids, nulls last, as many as there are up
    to `entries`, equal ids in order of their vectors; then come the rounds of `VectorBlocks.improved`.
    `code` is an array of entry numbers, the first of equally near ones; `error` sums the squared
    distances of the parts; `label_error` sums that over rows of the same label, nulls together.
    `VectorBlocks` says which rows take part. An empty table gives no rows and empty codebooks.
    """
    blocks = VectorBlocks(vectors, parts, scale, id_col, vec_col, label_col)
    if blocks.blocks is None:
        kind = T.StructType().add(id_col, blocks.id_type).add("label", blocks.label_type)
        kind = kind.add("code", T.ArrayType(T.IntegerType())).add("error", T.LongType())
        kind = kind.add("label_error", T.LongType())
        return vectors.sparkSession.createDataFrame([], kind), Codebooks(np.zeros((parts, 0, 0), np.int64))
    books = blocks.first(entries)
    for _ in range(rounds):
        books = blocks.improved(books)
    coded = written(blocks.codes(books), "codes")
    errors = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    errors = small(written(errors.select(F.col("label").alias("of"), "label_error"), "errors"))
    rows = coded.join(errors, F.col("label").eqNullSafe(F.col("of")))
    return rows.select(F.col("id").alias(id_col), "label", "code", "error", "label_error"), books


_SUMS = pa.schema(
    [("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("total", pa.list_(pa.int64()))]
)


def _integers(vectors: np.ndarray, scale: int) -> np.ndarray:
    scaled = np.floor(scale * vectors)
    if scaled.size and np.abs(scaled).max() >= LARGEST:
        raise ValueError("a component is too large for exact sums of squares")
    return scaled.astype(np.int64)


def _block(rows: pa.Table, parts: int, scale: int) -> pa.RecordBatch:
    """A row with the block's vectors as integers, and the trees' arrays by part."""
    rows = rows.combine_chunks()
    vec = rows.column("vec").chunk(0)
    flat = vec.flatten().to_numpy(zero_copy_only=False)
    points = _integers(flat.reshape(len(vec), -1), scale)
    trees = [ball_tree(part) for part in np.split(points, parts, axis=1)]
    n = pa.array([0, len(vec)], pa.int32())
    columns = [pa.ListArray.from_arrays(n, rows.column(name).chunk(0)) for name in ("id", "label")]
    columns.append(pa.array([points.astype("<i4").tobytes()], pa.binary()))
    for name in _TREE:
        arrays = [getattr(tree, name).astype(_KINDS[name]).tobytes() for tree in trees]
        columns.append(pa.array([arrays], pa.list_(pa.binary())))
    return pa.RecordBatch.from_arrays(columns, ["ids", "labels", "points", *_TREE])


def _blocks_of(
    batches: Iterator[pa.RecordBatch], parts: int
) -> Iterator[tuple[list[np.ndarray], list[BallTree], dict]]:
    """Of each block the points by part, the trees, and ids and labels."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i] for name in batch.schema.names}
            n = len(row["ids"])
            points = np.frombuffer(row["points"].as_py(), "<i4").reshape(n, -1).astype(np.int64)
            width = points.shape[1] // parts
            stored = {name: row[name].as_py() for name in _TREE}
            trees = []
            for p in range(parts):
                arrays = {name: np.frombuffer(stored[name][p], _KINDS[name]) for name in _TREE}
                arrays["total"] = arrays["total"].reshape(-1, width)
                trees.append(BallTree(**arrays))
            yield [np.ascontiguousarray(x) for x in np.split(points, parts, axis=1)], trees, row
