"""Bounded-space online packing of token sequences.

Each partition of the documents is packed on its own, in one pass: a document is encoded, what
fills whole windows leaves at once, and the rest goes into the open window it fits best. No more
than `open_windows` windows are open at a time; when a rest fits none, the fullest is emitted.
Where the fullest has at least `least_cut` places and the rest is long enough, the rest is cut to
fill it, so an emitted window lacks fewer than `least_cut` ids. At the end of a partition its open
windows are joined end to end into full windows and at most one partial; the partials of the
partitions are then merged in the same way, some thousand partitions to a task and level.

A task holds its open windows and one batch of rows. The result of the pass is written to the
shared folder before the merge reads it, so that a lost executor cannot change what was packed.
Which documents share a window depends on how the rows are partitioned; that every id lies in
exactly one piece does not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import give_back, quoted, ship, written
from sluice.llm.tokens import encoder

#: Partitions whose partial windows one task merges.
FAN_IN = 2048
#: Bytes of ids in a batch that goes back to Spark.
BATCH = 4_000_000
_SHIFT = 28  # bits for the windows of a task, and for the tasks of a level

_PIECE = [
    ("start", pa.int64()),
    ("length", pa.int64()),
    ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()),
    ("offset", pa.int64()),
    ("ids", pa.binary()),
    ("open", pa.bool_()),
    ("place", pa.int64()),
    ("position", pa.int64()),
]
_FIELDS = (
    "start long, length long, doc_tokens long, sequence_id long, offset long, ids binary, open boolean, "
    "place long, position long"
)

# document and its place in training, start in it, length, its ids in all, ids
Piece = tuple[tuple[object, int], int, int, int, np.ndarray]


class Packer:
    """Packs pieces in the order of arrival; emits windows as lists of pieces."""

    def __init__(self, size: int, open_windows: int, least_cut: int) -> None:
        self.size, self.most, self.least_cut = size, open_windows, least_cut
        self.used: list[int] = []
        self.windows: list[list[Piece]] = []

    def add(self, doc: object, ids: np.ndarray) -> Iterator[list[Piece]]:
        total, start = len(ids), 0
        while total - start >= self.size:
            yield [(doc, start, self.size, total, ids[start : start + self.size])]
            start += self.size
        if start < total:
            yield from self.place((doc, start, total - start, total, ids[start:]))

    def place(self, piece: Piece) -> Iterator[list[Piece]]:
        length = piece[2]
        best = -1
        for i, used in enumerate(self.used):
            if used + length <= self.size and (best < 0 or used > self.used[best]):
                best = i
        if best >= 0:
            self.windows[best].append(piece)
            self.used[best] += length
            if self.used[best] == self.size:
                yield self._close(best)
            return
        if len(self.used) >= self.most:
            fullest = max(range(len(self.used)), key=self.used.__getitem__)
            free = self.size - self.used[fullest]
            if free >= self.least_cut and length - free >= self.least_cut:
                head, piece = cut(piece, free)
                self.windows[fullest].append(head)
            yield self._close(fullest)
        self.windows.append([piece])
        self.used.append(piece[2])

    def _close(self, i: int) -> list[Piece]:
        self.used.pop(i)
        return self.windows.pop(i)

    def rest(self) -> Iterator[list[Piece]]:
        """The open windows joined end to end; only the last one may be partial."""
        pieces = [piece for window in self.windows for piece in window]
        self.windows, self.used = [], []
        return joined(pieces, self.size)


def cut(piece: Piece, at: int) -> tuple[Piece, Piece]:
    doc, start, length, total, ids = piece
    return (doc, start, at, total, ids[:at]), (doc, start + at, length - at, total, ids[at:])


def joined(pieces: list[Piece], size: int) -> Iterator[list[Piece]]:
    window: list[Piece] = []
    free = size
    for piece in pieces:
        while piece[2] > free:
            head, piece = cut(piece, free)
            yield [*window, head] if free else window
            window, free = [], size
        window.append(piece)
        free -= piece[2]
        if not free:
            yield window
            window, free = [], size
    if window:
        yield window


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 0,
    size: int = 1024,
    open_windows: int = 64,
    least_cut: int = 32,
    place: Column | None = None,
) -> DataFrame:
    """One row per piece: id_col, start, length, doc_tokens, sequence_id, offset, ids.

    With `place`, a number by which the documents are in order, also position: that of the first of
    the documents in the sequence, so that sorting by it brings the sequences in order.

    `ids` holds the piece's ids as little-endian unsigned 32-bit integers. A document is the ids
    of its whole text and then `end_id`, so an empty or null text is one id. Rows with a null or
    repeated id are documents like any other. An empty table gives no rows. Other columns of
    `docs` are left out.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    rows = docs.select(
        quoted(id_col).alias("doc"),
        quoted(text_col).cast("string").alias("text"),
        (F.lit(0) if place is None else F.coalesce(place, F.lit(0))).cast("long").alias("place"),
    )
    schema = T.StructType([T.StructField("doc", kind), *T._parse_datatype_string(_FIELDS).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, packer = encoder(tokenizer), Packer(size, open_windows, least_cut)
        out = None
        end = np.array([end_id], "<u4")
        for batch in batches:
            out = out or _Rows(batch.schema.field(0).type, 0, TaskContext.get().partitionId())
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                coded = coder.many(part.column(1).to_pylist())
                named = zip(part.column(0).to_pylist(), part.column(2).to_pylist())
                for doc, raw in zip(named, coded):
                    ids = np.concatenate([np.frombuffer(raw, coder.dtype).astype("<u4"), end])
                    for window in packer.add(doc, ids):
                        yield from out.put(window, False)
        if out:
            for window in packer.rest():
                yield from out.put(window, sum(piece[2] for piece in window) < size)
            yield from out.flush()
        give_back()

    packed = written(rows.mapInArrow(run, schema), "packed")
    return _merged(packed, size).select(
        quoted("doc").alias(id_col), "start", "length", "doc_tokens", "sequence_id", "offset", "ids",
        *([] if place is None else ["position"]),
    )


def _merged(packed: DataFrame, size: int) -> DataFrame:
    """The closed windows, and the partial ones put together level by level."""
    schema = packed.schema
    done = packed.filter(~F.col("open"))
    rest = packed.filter("open")
    task = F.shiftright("sequence_id", _SHIFT).bitwiseAND((1 << _SHIFT) - 1)
    tasks = rest.agg(F.max(task)).first()[0]
    level = 0
    while tasks is not None:
        level += 1
        last = tasks < FAN_IN

        def merge(batches: Iterator[pa.RecordBatch], level: int = level, last: bool = last):
            table = pa.Table.from_batches(list(batches))
            if not table.num_rows:
                return
            table = table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
            rows = table.to_pylist()
            pieces = [
                ((r["doc"], r["place"]), r["start"], r["length"], r["doc_tokens"], np.frombuffer(r["ids"], "<u4"))
                for r in rows
            ]
            group = (rows[0]["sequence_id"] >> _SHIFT & (1 << _SHIFT) - 1) // FAN_IN
            out = _Rows(table.schema.field("doc").type, level, group)
            for window in joined(pieces, size):
                yield from out.put(window, not last and sum(piece[2] for piece in window) < size)
            yield from out.flush()

        merged = written(rest.groupBy(F.floor(task / FAN_IN)).applyInArrow(_by_table(merge), schema), "merged")
        done = done.unionByName(merged.filter(~F.col("open")))
        rest = merged.filter("open")
        tasks = None if last else tasks // FAN_IN
    return done


def _by_table(merge):
    def run(table: pa.Table) -> pa.Table:
        out = list(merge(table.to_batches()))
        return pa.Table.from_batches(out) if out else table.slice(0, 0)

    return run


class _Rows:
    """Pieces gathered into batches of bounded size."""

    def __init__(self, kind: pa.DataType, level: int, task: int) -> None:
        self.schema = pa.schema([("doc", kind), *_PIECE])
        self.next = (level << 2 * _SHIFT) | (task << _SHIFT)
        self.clear()

    def clear(self) -> None:
        self.columns: list[list] = [[] for _ in self.schema]
        self.bytes = 0

    def put(self, window: list[Piece], is_open: bool) -> Iterator[pa.RecordBatch]:
        offset = 0
        position = min((piece[0][1] for piece in window), default=0)
        for (doc, place), start, length, total, ids in window:
            row = (doc, start, length, total, self.next, offset, ids.tobytes(), is_open, place, position)
            for column, value in zip(self.columns, row):
                column.append(value)
            offset += length
        self.next += 1
        self.bytes += 4 * offset
        if self.bytes >= BATCH:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.columns[0]:
            arrays = [pa.array(c, f.type) for c, f in zip(self.columns, self.schema)]
            yield pa.RecordBatch.from_arrays(arrays, schema=self.schema)
        self.clear()
