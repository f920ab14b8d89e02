"""Token ids in files of independent zstandard frames with a trailing seek table.

A file holds one frame per document, then a skippable frame with the documents' ids, then the
seek table of the public seekable zstandard format: for each frame its compressed size, its size
and the low 32 bits of the XXH64 of its content, and a footer. Any zstandard reader can unpack
the file; a reader that wants some documents reads the tail and unpacks their frames only.

Frames hold little-endian unsigned integers of 2 or 4 bytes, as the tokenizer's ids need; the
width is the first byte of the skippable frame with the ids.
"""

from __future__ import annotations

import os
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import give_back, quoted, ship, written
from sluice.llm.tokens import encoder

INDEX_MAGIC = 0x184D2A50
SEEK_MAGIC = 0x184D2A5E
SEEK_FOOTER = 0x8F92EAB1
HAS_CHECKSUMS = 0x80

#: Bytes of ids in a batch that goes back to Spark.
BATCH = 4_000_000


#: Schemes of Hadoop's clients and what pyarrow calls them.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def arrow_uri(uri: str) -> str:
    """The URI with the scheme by which pyarrow knows the store."""
    scheme, sign, rest = uri.partition("://")
    return SCHEMES.get(scheme.lower(), scheme) + sign + rest


def open_file(uri: str, mode: str) -> BinaryIO:
    """A file by path or URI, on any store that pyarrow can open, with credentials of its own."""
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        path = unquote(parts.path) if parts.scheme else uri
        if "w" in mode:
            os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, mode)
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(arrow_uri(uri))
    return store.open_output_stream(path) if "w" in mode else store.open_input_file(path)


class TokenFileWriter:
    def __init__(self, file: BinaryIO, width: int, level: int = 3) -> None:
        import zstandard

        self.file, self.width = file, width
        self.compress = zstandard.ZstdCompressor(level=level, write_content_size=True).compress
        self.entries: list[tuple[int, int, int]] = []
        self.docs: list[int | None] = []

    def add(self, doc: int | None, raw: bytes) -> None:
        import xxhash

        frame = self.compress(raw)
        self.file.write(frame)
        self.entries.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.docs.append(doc)

    def close(self) -> None:
        known = np.array([doc is not None for doc in self.docs], bool)
        ids = np.array([doc or 0 for doc in self.docs], "<i8")
        index = bytes([self.width]) + ids.tobytes() + known.tobytes()
        self.file.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        table = np.array(self.entries, "<u4").tobytes()
        footer = struct.pack("<IBI", len(self.entries), HAS_CHECKSUMS, SEEK_FOOTER)
        self.file.write(struct.pack("<II", SEEK_MAGIC, len(table) + len(footer)) + table + footer)
        self.file.close()


class TokenFileReader:
    """Reads the tail of a file; unpacks frames when asked."""

    def __init__(self, file: BinaryIO) -> None:
        import zstandard

        self.file = file
        self.unpack = zstandard.ZstdDecompressor().decompress
        size = file.seek(0, os.SEEK_END)
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_FOOTER or not flags & HAS_CHECKSUMS:
            raise ValueError("the file has no seek table with checksums")
        head = size - 9 - 12 * n - 8
        if struct.unpack("<II", self._at(head, 8)) != (SEEK_MAGIC, 12 * n + 9):
            raise ValueError("the seek table is broken")
        self.table = np.frombuffer(self._at(head + 8, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.table[:, 0])])
        magic, length = struct.unpack("<II", self._at(int(self.begin[-1]), 8))
        index = self._at(int(self.begin[-1]) + 8, length)
        if magic != INDEX_MAGIC or length != 1 + 9 * n:
            raise ValueError("the index of documents is broken")
        self.width = index[0]
        self.docs = np.frombuffer(index, "<i8", n, 1)
        self.known = np.frombuffer(index, bool, n, 1 + 8 * n)

    def _at(self, place: int, length: int) -> bytes:
        self.file.seek(place)
        return self.file.read(length)

    def __len__(self) -> int:
        return len(self.table)

    @property
    def counts(self) -> np.ndarray:
        """Ids of each document."""
        return self.table[:, 1] // self.width

    def frame(self, i: int, packed: bytes | None = None) -> np.ndarray:
        import xxhash

        if packed is None:
            packed = self._at(int(self.begin[i]), int(self.table[i, 0]))
        raw = self.unpack(packed)
        if len(raw) != self.table[i, 1] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.table[i, 2]:
            raise ValueError(f"frame {i} does not match its checksum")
        return np.frombuffer(raw, f"<u{self.width}")

    def frames(self) -> Iterator[np.ndarray]:
        """All frames, read in order."""
        self.file.seek(0)
        for i in range(len(self)):
            yield self.frame(i, self.file.read(int(self.table[i, 0])))


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 2,
) -> DataFrame:
    """Write all documents in ascending order of id; returns one row per file.

    Columns: part (files in this order hold the documents in order), file, n_docs, n_tokens, and
    start, the ids in the files before. A document is the ids of its whole text and `end_id`; a
    null text counts as empty. Null ids come first. Rows with the same id are all written, ordered
    by a hash of their text. An empty table gives no files. `folder` must be one that executors
    share; file names are new for every attempt of a task, and a file counts only if the returned
    table names it. Other columns of `docs` are left out.
    """
    ship(docs.sparkSession)
    rows = docs.select(quoted(id_col).cast("long").alias("doc"), quoted(text_col).cast("string").alias("text"))
    order = [F.col("doc"), F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    folder = folder.rstrip("/")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, out = encoder(tokenizer), None
        part, tokens = TaskContext.get().partitionId(), 0
        end = np.array([end_id], coder.dtype).tobytes()
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                some = batch.slice(start, 256)
                if out is None:
                    file = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.tok.zst"
                    out = TokenFileWriter(open_file(file, "wb"), coder.width)
                for doc, raw in zip(some.column(0).to_pylist(), coder.many(some.column(1).to_pylist())):
                    out.add(doc, raw + end)
                    tokens += len(raw) // coder.width + 1
        if out:
            out.close()
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "file": file, "n_docs": len(out.docs), "n_tokens": tokens}]
            )
        give_back()

    files = written(ordered.mapInArrow(write, "part long, file string, n_docs long, n_tokens long"), "files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_token_files(files: DataFrame, wanted: list[int] | None = None) -> DataFrame:
    """One row per document: doc_id, start, n_tokens, ids (little-endian unsigned 32-bit).

    `files` is what `write_token_files` returned. With `wanted`, a list of ids that fits into
    a closure, only the frames of these documents are read and unpacked. Documents of null texts
    have their end id alone; those of a repeated id are all returned. No files, no rows.
    """
    spark: SparkSession = files.sparkSession
    ship(spark)
    n = files.count()
    chosen = None if wanted is None else np.array(sorted(set(wanted)), np.int64)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file = open_file(row["file"], "rb")
                reader = TokenFileReader(file)
                starts = row["start"] + np.concatenate([[0], np.cumsum(reader.counts)])
                if chosen is None:
                    frames = enumerate(reader.frames())
                else:
                    hits = np.flatnonzero(reader.known & np.isin(reader.docs, chosen))
                    frames = ((int(i), reader.frame(int(i))) for i in hits)
                rows: list[tuple] = []
                held = 0
                for i, ids in frames:
                    doc = int(reader.docs[i]) if reader.known[i] else None
                    rows.append((doc, int(starts[i]), len(ids), ids.astype("<u4").tobytes()))
                    held += 4 * len(ids)
                    if held >= BATCH:
                        yield _batch(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, schema)
                file.close()

    fields = T._parse_datatype_string("doc_id long, start long, n_tokens long, ids binary")
    return files.select("file", "start").repartition(max(1, n)).mapInArrow(read, fields)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    arrays = [pa.array(column, field.type) for column, field in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
