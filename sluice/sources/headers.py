"""First lines of landed files, read by the tasks that Spark deals the files to.

The driver opens none of the files. A task opens each of its own as a stream and stops at the end
of the first line that counts. Files of a store or a codec that Python does not know are read by
Spark's text source, also in tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A header longer than this is an error.
HEADER_LIMIT = 1 << 20

BOM = "\ufeff"

# What became of a file.
LINE, NO_LINE, TOO_LONG, UNOPENED = "line", "no line", "too long", "unopened"

_HEADED = "path string, uri string, length long, state string, digest binary, line binary"


class HeaderError(ValueError):
    """The header of a file cannot be used."""


@dataclass(frozen=True)
class LandedFile:
    """``line`` is the first one that is neither blank nor a comment, None if there is none.

    As bytes: lines in an encoding other than UTF-8 stay apart.
    """

    path: str
    uri: str
    length: int
    line: bytes | None = None


def landed_files(files: DataFrame, options: Mapping[str, str], literal: Callable[[str], str]) -> list[LandedFile]:
    """The files of a micro-batch (path, length, uri) with their first lines, in order of their URIs.

    One job, whose tasks open the files where Spark's scan dealt them. A task sends each distinct
    line once, so what comes to the driver is a few numbers for each file and the distinct lines.
    A second job reads the files that Python could not open, if there are any.
    """
    spark = files.sparkSession
    given = {name.lower(): value for name, value in options.items()}
    end, comment = given.get("linesep"), given.get("comment", "")
    reader = header_reader(codec_suffixes(spark), end, comment, HEADER_LIMIT)
    rows = files.select("path", "uri", "length").mapInArrow(reader, _HEADED).collect()
    lines = {bytes(row.digest): bytes(row.line) for row in rows if row.line is not None}
    line_of = {row.uri: lines[bytes(row.digest)] for row in rows if row.state == LINE}
    long = [row.path for row in rows if row.state == TOO_LONG]
    unopened = [row.path for row in rows if row.state == UNOPENED]
    if unopened:
        names = [literal(path) for path in unopened]
        expected = {row.uri for row in rows if row.state == UNOPENED}
        for row in lines_by_spark(spark, names, end, comment, HEADER_LIMIT).collect():
            if row.uri not in expected:
                raise HeaderError(f"{row.uri} is not a file of this micro-batch")
            if row.line is None:
                long.append(row.uri)
            else:
                line_of[row.uri] = bytes(row.line)
    if long:
        raise HeaderError(f"the header of {min(long)} has more than {HEADER_LIMIT} bytes")
    found = {row.uri: LandedFile(row.path, row.uri, row.length, line_of.get(row.uri)) for row in rows}
    return [found[uri] for uri in sorted(found)]


def codec_suffixes(spark: SparkSession) -> dict[str, str]:
    """Suffix of a file's name -> class of the codec that Spark unpacks it with."""
    settings = spark._jsparkSession.sessionState().newHadoopConf()
    factory = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory
    found = {}
    for kind in factory.getCodecClasses(settings):
        codec = spark._jvm.org.apache.hadoop.util.ReflectionUtils.newInstance(kind, settings)
        found[codec.getDefaultExtension()] = kind.getSimpleName()
    return found


def header_reader(
    suffixes: Mapping[str, str], end: str | None, comment: str, limit: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What a task does with its files.

    All that it needs is in here, so executors need pyarrow but not this library.
    """
    blanks = bytes(range(33))
    states = (LINE, NO_LINE, TOO_LONG, UNOPENED)
    bom = BOM.encode()
    mark = comment.encode()
    # like Spark's reader: either sign ends a line; the blank one between them does not count
    pattern = end.encode() if end else None
    names = _HEADED

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import bz2
        import gzip
        import hashlib
        import re

        import pyarrow as pa

        ends = re.compile(re.escape(pattern) if pattern else b"[\r\n]")
        stores: dict[tuple[str, str], tuple] = {}

        def opened(path: str):
            scheme, colon, rest = path.partition(":")
            if not colon or "/" in scheme:
                stream = open(path, "rb")
            elif scheme == "file":
                stream = open("/" + rest.lstrip("/"), "rb")
            else:
                place, _, name = rest.lstrip("/").partition("/")
                if (scheme, place) not in stores:
                    from pyarrow import fs

                    known = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
                    stores[scheme, place] = fs.FileSystem.from_uri(f"{known}://{place}/")
                store, base = stores[scheme, place]
                stream = store.open_input_stream(f"{base.rstrip('/')}/{name}" if base else name, compression=None)
            codec = next((kind for suffix, kind in suffixes.items() if path.endswith(suffix)), None)
            if codec == "GzipCodec":
                return stream, gzip.GzipFile(fileobj=stream)
            if codec == "BZip2Codec":
                return stream, bz2.BZ2File(stream)
            if codec is not None:
                stream.close()
                raise ValueError(f"{codec} is not known here")
            return stream, stream

        def first_line(source) -> tuple[str, bytes | None]:
            held, start, looked, fresh = b"", 0, 0, True
            while True:
                found = ends.search(held, looked)
                if found is None and len(held) - start <= limit + len(bom):
                    more = source.read(1 << 16)
                    if more:
                        held, looked = held[start:] + more, max(0, len(held) - start - len(pattern or b""))
                        start = 0
                        continue
                line = held[start : found.start() if found else len(held)]
                line = line.removeprefix(bom) if fresh else line
                fresh = False
                if len(line) > limit:
                    return states[2], None
                if line.strip(blanks) and not (mark and line.startswith(mark)):
                    return states[0], line
                if found is None:
                    return states[1], None
                start = looked = found.end()

        def state_of(path: str) -> tuple[str, bytes | None]:
            try:
                stream, source = opened(path)
                try:
                    return first_line(source)
                finally:
                    stream.close()
            except (OSError, ValueError, ImportError, EOFError, NotImplementedError, pa.ArrowException):
                return states[3], None

        sent: set[bytes] = set()
        for batch in batches:
            paths, uris, lengths = (batch.column(i) for i in range(3))
            found = [state_of(path) for path in paths.to_pylist()]
            digests, lines = [], []
            for _, line in found:
                digest = None if line is None else hashlib.sha256(line).digest()
                digests.append(digest)
                lines.append(None if digest in sent else line)
                sent.add(digest)
            columns = [paths, uris, lengths, pa.array([state for state, _ in found], pa.string()),
                       pa.array(digests, pa.binary()), pa.array(lines, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in names.split(", ")])

    return read


def lines_by_spark(
    spark: SparkSession, paths: Sequence[str], end: str | None, comment: str, limit: int
) -> DataFrame:
    """Rows (uri, line) of the first lines, by Spark's text source; a line over the limit is NULL.

    Reads the files to their end, as nothing ends the reading of a partition before.
    """
    reader = spark.read.option("lineSep", end) if end else spark.read
    lines = reader.text(list(paths)).select(
        F.col("_metadata.file_path").alias("uri"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("number"),
        F.col("value").cast("binary").alias("raw"),
    )
    # as bytes: text functions would replace what is not UTF-8
    has_bom = F.substring("raw", 1, len(BOM.encode())) == F.lit(BOM.encode())
    rest = F.expr(f"substring(raw, {len(BOM.encode()) + 1})")
    lines = lines.withColumn("raw", F.when(has_bom, rest).otherwise(F.col("raw")))
    lines = lines.withColumn("value", F.col("raw").cast("string"))
    counts = F.col("value").rlike("[^\\x00-\\x20]")
    if comment:
        counts &= ~F.col("value").startswith(comment)
    line = F.when(F.octet_length("raw") <= limit, F.col("raw"))
    first = F.min(F.struct("block", "number", line.alias("line"))).alias("first")
    first = lines.filter(counts).groupBy("uri").agg(first)
    return first.select("uri", "first.line")
