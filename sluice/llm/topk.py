"""Exact top-k search by integer inner product over a bit-sliced index.

Vectors are turned into integers and gathered into blocks. For every component a block holds a
quantised code as bitmaps over its rows, one bitmap per bit. The score of all rows of a block for
a query is formed with bitmap arithmetic: the bitmaps that a query's weights call for are added
with carry-save adders into the bit slices of the sum. Going through these slices from the most
significant downward finds the k-th largest sum; the rows whose sum lies within the quantisation
error of it are the boundary rows, and their scores are computed exactly from the integers.

The search is a grid: blocks of the index are dealt to parts, blocks of queries to others, and a task
gets one part of each. It holds its queries, of bounded size, with the best rows so far of each, and
takes the blocks of the index one after the other. What is carried on is at most k rows per query and
part of the index.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import quoted, ship, written

#: Rows of a block of the index, and queries of a block of queries, at most.
BLOCK_ROWS = 16_384
QUERY_ROWS = 32
#: Bytes of the 64-bit integers of a block, at most, if it has more than one row.
BLOCK_BYTES = 32 << 20
#: Bytes of the queries that a task holds, with their best rows, about.
PART_BYTES = 64 << 20
#: Searches of a query in a block (about a millisecond each) that are worth a task of their own.
TASK_SEARCHES = 1024
#: Bytes that a query takes in a task besides its numbers and results, about.
_OBJECTS = 400
#: Bits of a quantised component.
CODE_BITS = 6
#: Scores must stay below this for 64-bit arithmetic.
LARGEST = 1 << 62

_VECTORS = "block long, n int, dims int, ids binary, ints binary"
_BLOCK = f"{_VECTORS}, low binary, shift int, slices binary"
_KINDS = {"block": pa.int64(), "n": pa.int32(), "dims": pa.int32(), "shift": pa.int32()}


def index_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 1024
) -> DataFrame:
    """A row per block: the ids, the integers floor(scale * x) and the slices of their codes.

    Rows with a null id, a null vector or null or non-finite components are left out. Vectors of
    different lengths may meet; what a shorter one lacks counts as zero. Repeated rows are all
    indexed, other columns left out; an empty table has no blocks.
    """
    ship(vectors.sparkSession)
    blocks = _blocks(vectors, id_col, vec_col, scale, BLOCK_ROWS, _BLOCK, slices)
    return written(blocks, "vector-index", group_rows=1)


def _blocks(
    vectors: DataFrame,
    id_col: str,
    vec_col: str,
    scale: int,
    rows: int,
    schema: str = _VECTORS,
    more: Callable[[np.ndarray], dict] | None = None,
) -> DataFrame:
    """Blocks of at most `rows` vectors, with what `more` makes of a block's integers."""
    usable = vectors.select(
        quoted(id_col).cast("long").alias("id"), quoted(vec_col).cast("array<double>").alias("vec")
    ).filter(
        F.col("id").isNotNull()
        & F.col("vec").isNotNull()
        & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    )
    most = BLOCK_BYTES

    def fitting(dims: int) -> int:
        return max(1, min(rows, most // (8 * max(1, dims))))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, parts, held, dims = TaskContext.get().partitionId() << 32, [], [], 0, 0
        for batch in batches:
            step = fitting(pc.max(pc.list_value_length(batch.column(1))).as_py() or 0)
            for start in range(0, batch.num_rows, step):
                some = batch.slice(start, step)
                own = some.column(0).to_numpy(zero_copy_only=False)
                ints = _integers(some.column(1), scale)
                while len(ints):
                    room = fitting(max(dims, ints.shape[1])) - held
                    if room <= 0:
                        yield _vector_block(number, ids, parts, more)
                        number, ids, parts, held, dims = number + 1, [], [], 0, 0
                        continue
                    ids.append(own[:room])
                    parts.append(ints[:room])
                    held, dims = held + len(parts[-1]), max(dims, ints.shape[1])
                    own, ints = own[room:], ints[room:]
        if held:
            yield _vector_block(number, ids, parts, more)

    return usable.mapInArrow(gather, schema)


def _integers(vectors: pa.ListArray, scale: int) -> np.ndarray:
    lengths = np.diff(vectors.offsets.to_numpy())
    flat = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if flat.size and np.abs(flat).max() >= LARGEST:
        raise ValueError("a component is too large for 64-bit integers")
    dims = int(lengths.max(initial=0))
    out = np.zeros((len(lengths), dims), np.int64)
    out[np.arange(dims) < lengths[:, None]] = flat.astype(np.int64)
    return out


def _vector_block(
    number: int, ids: list[np.ndarray], parts: list[np.ndarray], more: Callable[[np.ndarray], dict] | None
) -> pa.RecordBatch:
    dims = max(part.shape[1] for part in parts)
    ints = np.concatenate([np.pad(part, ((0, 0), (0, dims - part.shape[1]))) for part in parts])
    row = {
        "block": number,
        "n": len(ints),
        "dims": dims,
        "ids": np.concatenate(ids).astype("<i8").tobytes(),
        "ints": _narrow(ints).tobytes(),
    }
    row |= more(ints) if more else {}
    schema = pa.schema([(name, _KINDS.get(name, pa.binary())) for name in row])
    return pa.RecordBatch.from_pylist([row], schema)


def _narrow(ints: np.ndarray) -> np.ndarray:
    """The integers in as few bytes each as hold all of them."""
    least, most = int(ints.min(initial=0)), int(ints.max(initial=0))
    return ints.astype(next(f"<i{n}" for n in (1, 2, 4, 8) if -(1 << 8 * n - 1) <= least and most < 1 << 8 * n - 1))


def _matrix(data: bytes | pa.Buffer, n: int, dims: int) -> np.ndarray:
    """The integers of a row of a table of blocks, in the width they were stored in."""
    size = len(memoryview(data)) // max(1, n * dims) or 8
    return np.frombuffer(data, f"<i{size}").reshape(n, dims)


def slices(ints: np.ndarray) -> dict:
    """The least integer of each component, the shift of the codes, and their bits as bitmaps."""
    low = ints.min(axis=0, initial=np.iinfo(np.int64).max) if len(ints) else np.zeros(ints.shape[1], np.int64)
    above = (ints - low).astype(np.uint64)
    shift = max(0, int(above.max(initial=0)).bit_length() - CODE_BITS)
    codes = (above >> np.uint64(shift)).astype(np.uint8)
    bits = [_words((codes >> p & 1).T) for p in range(CODE_BITS)]
    return {"low": low.astype("<i8").tobytes(), "shift": shift, "slices": np.stack(bits, 1).tobytes()}


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of 0 and 1 packed into 64-bit words."""
    packed = np.packbits(bits.astype(bool), axis=1, bitorder="little")
    return np.ascontiguousarray(np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))).view("<u8")


class Block:
    """A block of the index, ready for queries."""

    def __init__(self, row: dict) -> None:
        self.n, self.dims, self.shift = row["n"], row["dims"], row["shift"]
        self.ids = np.frombuffer(row["ids"], "<i8")
        self.ints = _matrix(row["ints"], self.n, self.dims)
        self.low = np.frombuffer(row["low"], "<i8")
        high = self.ints.max(axis=0).astype(np.int64) if self.n else self.low
        self.all = _words(np.ones((1, self.n), np.uint8))[0]
        bits = np.frombuffer(row["slices"], "<u8").reshape(self.dims * CODE_BITS, len(self.all))
        self.slices = np.concatenate([bits, ~bits])  # of the codes, and of their complements
        self.most = np.maximum(np.abs(self.low), np.abs(high))

    def sums(self, weights: np.ndarray) -> list[np.ndarray]:
        """Bit slices of the sum over components of |weight| * code, least significant first.

        Where a weight is negative the code is complemented, which adds a constant to the sum.
        """
        size = np.abs(weights)
        width = int(size.max(initial=0)).bit_length()
        first = (np.arange(self.dims) + np.where(weights < 0, self.dims, 0)) * CODE_BITS
        chosen = [first[size >> b & 1 == 1] for b in range(width)]
        out: list[np.ndarray] = []
        carried: list[np.ndarray] = []
        place = 0
        while place < width + CODE_BITS - 1 or carried:
            some = [chosen[b] + (place - b) for b in range(max(0, place - CODE_BITS + 1), min(width, place + 1))]
            rows = np.concatenate(some) if some else np.zeros(0, np.int64)
            here = np.concatenate([self.slices[rows], *carried])
            left, carried = len(here), []
            while left > 1:
                m = left // 3
                if m:  # full adders: three bitmaps of this place give one, and one of the next
                    a, b, c = here[:m], here[m : 2 * m], here[2 * m : 3 * m]
                    carry = b ^ c
                    a ^= b
                    carry &= a
                    carry ^= b
                    a ^= c
                    here[m : left - 2 * m] = here[3 * m : left]
                    left -= 2 * m
                else:
                    carry = here[:1] & here[1:2]
                    here[0] ^= here[1]
                    left = 1
                carried.append(carry)
            out.append(here[0] if left else np.zeros(len(self.all), np.uint64))
            place += 1
        return out

    def top(
        self, own: int, query: np.ndarray, k: int, least: int | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows, ties to the smaller id, without rows of id `own`.

        With `least`, rows of a lower score may be left out.
        """
        weights = np.zeros(self.dims, np.int64)
        common = min(self.dims, len(query))
        weights[:common] = query[:common]
        bound = float(np.abs(weights).astype(np.float64) @ self.most.astype(np.float64))
        if bound >= LARGEST / 2 and sum(abs(int(w)) * int(m) for w, m in zip(weights, self.most)) >= LARGEST:
            raise ValueError("scores exceed 64-bit integers")
        allowed = self.all
        for row in np.flatnonzero(self.ids == own):
            allowed = allowed.copy() if allowed is self.all else allowed
            allowed[row >> 6] &= ~np.uint64(1 << (int(row) & 63))
        rows = allowed
        if least is not None or int(np.bitwise_count(allowed).sum()) > k:
            rows = self._likely(weights, allowed, k, least)
        at = np.flatnonzero(np.unpackbits(rows.view(np.uint8), bitorder="little"))
        scores = self.ints[at].astype(np.int64) @ weights
        order = np.lexsort((self.ids[at], -scores))[:k]
        return self.ids[at][order], scores[order]

    def _likely(self, weights: np.ndarray, allowed: np.ndarray, k: int, least: int | None) -> np.ndarray:
        """A superset of the k best of the allowed rows, or of those of a score of `least` and more."""
        # what a code leaves out lies between 0 and 2^shift - 1; least and most over all weights
        left_out = (1 << self.shift) - 1
        above = sum(w for w in weights.tolist() if w > 0)
        below = -sum(w for w in weights.tolist() if w < 0)
        sums = self.sums(weights)
        if least is not None:
            flipped = below * (((1 << CODE_BITS) - 1) << self.shift)
            none = sum(w * low for w, low in zip(weights.tolist(), self.low.tolist())) - flipped
            return self._at_least(sums, allowed, -(-(least - none - above * left_out) >> self.shift))
        equal, wanted, kth = allowed, k, 0
        for place in range(len(sums) - 1, -1, -1):
            with_bit = equal & sums[place]
            count = int(np.bitwise_count(with_bit).sum())
            if count >= wanted:
                equal, kth = with_bit, kth | 1 << place
            else:
                wanted -= count
                equal = equal & ~sums[place]
        error = (above + below) * left_out
        return self._at_least(sums, allowed, kth - (-(-error >> self.shift)))

    @staticmethod
    def _at_least(sums: list[np.ndarray], allowed: np.ndarray, least: int) -> np.ndarray:
        if least <= 0:
            return allowed
        if least >> len(sums):
            return np.zeros_like(allowed)
        greater, equal = np.zeros_like(allowed), allowed
        for place in range(len(sums) - 1, -1, -1):
            if least >> place & 1:
                equal = equal & sums[place]
            else:
                greater = greater | (equal & sums[place])
                equal = equal & ~sums[place]
        return greater | equal


def top_k(
    vectors: DataFrame,
    queries: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    scale: int = 1024,
) -> DataFrame:
    """For each row for which `queries` is true, its k best other rows: query_id, rank, vec_id, score.

    Every usable row is indexed and a candidate, but rows with the query's own id. Score is the
    inner product of the integers; ties go to the smaller id, and fewer candidates than k are all
    returned. Rows repeated with one id are candidates each; if they are queries, each is asked,
    and ranks start anew. Empty tables give no rows. Scores or components beyond 62 bits are
    errors. Other columns are left out.
    """
    index = index_vectors(vectors, id_col, vec_col, scale)
    asked = written(
        _blocks(vectors.filter(queries), id_col, vec_col, scale, QUERY_ROWS), "queries", group_rows=512
    )
    before, parts, asks = _grid(index, asked, k)
    writer, place = F.shiftright("block", 32).cast("int"), F.col("block").bitwiseAND(F.lit((1 << 32) - 1))

    def dealt(blocks: DataFrame, kind: int, part: Column, of_asks: Column) -> DataFrame:
        cell = (part * asks + of_asks).cast("int").alias("cell")
        rest = [F.col(c) if c in blocks.columns else F.lit(None).cast(t).alias(c) for c, t in index.dtypes]
        return blocks.select(cell, F.lit(kind).alias("kind"), *rest)

    def each(of: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(of - 1)))

    of_queries = dealt(
        asked.withColumn("part", each(parts)), 0, F.col("part"), F.pmod(F.xxhash64("block"), F.lit(asks))
    )
    of_index = dealt(
        index.withColumn("asks", each(asks)), 1, (F.get(F.lit(before), writer) + place) % parts, F.col("asks")
    )
    cells = of_queries.unionByName(of_index).repartitionById(parts * asks, "cell")
    found = written(
        cells.sortWithinPartitions("cell", "kind", "block").mapInArrow(
            _searching(k), "q_block long, q_row long, query_id long, vec_id long, score long"
        ),
        "found",
    )
    best = Window.partitionBy("q_block", "q_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _grid(index: DataFrame, asked: DataFrame, k: int) -> tuple[list[int], int, int]:
    """How many parts of the index, and of the queries, the search is dealt to.

    About as many tasks as a shuffle has, if the work is worth them. A block of the index goes to
    every part of the queries and the other way round, so the larger side is cut more often; a part
    of the queries is what a task can hold. First comes, for each task that wrote the index, the
    number of blocks of those before it, by which the blocks are dealt evenly.
    """
    n, writer = F.col("n").cast("long"), F.shiftright("block", 32).alias("writer")
    sums = [F.count(F.lit(1)).alias("blocks"), F.sum(n).alias("rows"), F.sum(n * F.col("dims")).alias("numbers")]
    wrote = index.groupBy(writer).agg(*sums).orderBy("writer").collect()
    of_queries = asked.agg(*sums).first()
    if not (wrote and of_queries.blocks):
        return [0], 1, 1
    before, blocks = [0] * (wrote[-1].writer + 1), 0
    for row in wrote:
        before[row.writer], blocks = blocks, blocks + row.blocks
    rows, numbers = (sum(row[c] for row in wrote) for c in ("rows", "numbers"))
    results = min(k, rows)
    held = 8 * of_queries.numbers + of_queries.rows * (_OBJECTS + 16 * results)
    width = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(1, min(width, blocks * of_queries.rows // TASK_SEARCHES))
    # bytes of the index for a byte of the queries and what they find, as they are moved
    ratio = (3 * numbers + 8 * rows) / (2 * of_queries.numbers + of_queries.rows * (8 + 24 * results))
    parts = max(1, min(blocks, round(math.sqrt(tasks * ratio))))
    asks = max(1, math.ceil(held / PART_BYTES), round(tasks / parts))
    return before, parts, min(of_queries.blocks, asks)


def _searching(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each cell, the queries come first."""
        cell, asked = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["cell"] != cell:
                    for asks in asked:
                        yield asks.found()
                    cell, asked = row["cell"], []
                if row["kind"] == 0:
                    asked.append(Asks(row))
                else:
                    block = Block(row)
                    for asks in asked:
                        asks.meet(block, k)
        for asks in asked:
            yield asks.found()

    return search


class Asks:
    """A block of queries, with the best rows of each so far."""

    def __init__(self, row: dict) -> None:
        self.block = row["block"]
        self.ids = np.frombuffer(row["ids"], "<i8").tolist()
        self.ints = _matrix(row["ints"], row["n"], row["dims"])
        nothing = np.zeros(0, np.int64)
        self.best = [(nothing, nothing)] * row["n"]

    def meet(self, block: Block, k: int) -> None:
        for j, (ids, scores) in enumerate(self.best):
            least = int(scores[-1]) if len(ids) == k > 0 else None
            more, of_more = block.top(self.ids[j], self.ints[j], k, least)
            if len(more):
                ids, scores = np.concatenate([ids, more]), np.concatenate([scores, of_more])
                order = np.lexsort((ids, -scores))[:k]
                self.best[j] = ids[order], scores[order]

    def found(self) -> pa.RecordBatch:
        counts = [len(ids) for ids, _ in self.best]
        columns = {
            "q_block": np.full(sum(counts), self.block),
            "q_row": np.repeat(np.arange(len(counts)), counts),
            "query_id": np.repeat(np.array(self.ids, np.int64), counts),
            "vec_id": np.concatenate([ids for ids, _ in self.best]),
            "score": np.concatenate([scores for _, scores in self.best]),
        }
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns.values()], list(columns))
