"""CSV files read by column name, whatever order each file has its columns in.

Spark matches CSV columns by position. Here the files of a batch are grouped by header,
each group is read with its own columns, and the groups are combined by name.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.columns import quoted, quoted_all
from sluice.sources.headers import HeaderError, LandedFile

# Where a row came from: the file and its time of modification, its split, and a number that
# grows within the split. Together they are the order of the rows, whichever micro-batch took
# a file up.
SOURCE_FILE = "_source_file"
FILE_TIME = "_file_time"
BLOCK_START = "_block_start"
ROW_ID = "_row_id"
ROW_ORDER = (FILE_TIME, SOURCE_FILE, BLOCK_START, ROW_ID)
# The whole line, where it has more or fewer cells than its file's header.
UNFIT = "_unfit_line"
POSITION = (*ROW_ORDER, UNFIT)
# Spark's own name for what it knows of a row's file.
METADATA = "_metadata"

LISTING = "path string, modificationTime timestamp, length long, content binary"


@dataclass(frozen=True)
class HeaderGroup:
    columns: tuple[str, ...]
    paths: tuple[str, ...]


def new_files(
    spark: SparkSession, directory: str, max_files: int, max_file_age: str, cleaning: Mapping[str, str] | None = None
) -> DataFrame:
    """Stream of the files that appear under a directory, at any depth, old ones included.

    The binary source lists files; its content column is pruned, so nothing is read here.
    ``max_file_age`` bounds the list of seen files the stream keeps: a file that much older
    than the newest one is passed over. ``cleaning`` are the file source's options for files
    that it is done with: it moves or deletes those of a micro-batch once the next one is committed.
    """
    return (
        spark.readStream.format("binaryFile")
        .schema(LISTING)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .option("maxFileAge", max_file_age)
        .options(**(cleaning or {}))
        .load(directory)
        .select("path", "length", F.col("_metadata.file_path").alias("uri"))
    )


def literal_path(path: str) -> str:
    """A path a reader takes as it is: glob characters escaped."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


@contextmanager
def session_settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def own_session(spark: SparkSession, settings: Mapping[str, str]) -> SparkSession:
    """A session with the settings of this one and some of its own, on the same catalog.

    Other work of the given session, also at the same time, does not see them.
    """
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            session.conf.set(name, value)
    for name, value in settings.items():
        session.conf.set(name, value)
    return session


# A list of files is checked path by path; Spark would start a task for each of them.
FEW_LISTING_TASKS = {"spark.sql.sources.parallelPartitionDiscovery.parallelism": "256"}

# Options of a CSV reader that do not concern the cells of a single line.
_NOT_OF_A_LINE = frozenset(
    "header multiline linesep encoding charset comment mode inferschema columnnameofcorruptrecord enforceschema".split()
)
_END = "end\u0001of the header"


def header_cells(
    spark: SparkSession, lines: Sequence[bytes], options: Mapping[str, str]
) -> list[list[str | None] | None]:
    """The cells of header lines, by Spark's CSV parser, all in one go.

    None for a line that cannot be told on its own: not UTF-8, or with a quoted cell that may
    run on to the next line.
    """
    given = {name.lower(): value for name, value in options.items()}
    quote = given.get("quote") or '"'
    sep = given.get("sep", given.get("delimiter", ","))
    encoding = given.get("encoding", given.get("charset", "utf-8")).lower().replace("_", "-")
    texts: dict[int, str] = {}
    for i, line in enumerate(lines):
        if encoding in ("utf-8", "utf8") and line.count(quote.encode()) % 2 == 0:
            texts[i] = line.decode(errors="replace").rstrip("\r")
    out: list[list[str | None] | None] = [None] * len(lines)
    if texts:
        width = max(text.count(sep) for text in texts.values()) + 2
        schema = ", ".join(f"c{i} string" for i in range(width))
        of_a_line = {name: value for name, value in options.items() if name.lower() not in _NOT_OF_A_LINE}
        rows = spark.createDataFrame([(i, f"{text}{sep}{_END}") for i, text in texts.items()], "i int, line string")
        cells = rows.select("i", F.from_csv("line", F.lit(schema), of_a_line).alias("cells"))
        for i, row in cells.collect():
            found = list(row)
            out[i] = found[: found.index(_END)] if _END in found else None
    return out


def safe_names(cells: Sequence[str | None], null_value: str, case_sensitive: bool) -> tuple[str, ...]:
    """Column names as Spark makes them of a header: blank cells and repeated names get their place."""
    plain = [cell if case_sensitive or cell is None else cell.lower() for cell in cells]
    names = []
    for place, cell in enumerate(cells):
        if not cell or cell == null_value:
            names.append(f"_c{place}")
        elif plain.count(plain[place]) > 1:
            names.append(f"{cell}{place}")
        else:
            names.append(cell)
    return tuple(names)


def header_groups(
    spark: SparkSession, files: Sequence[LandedFile], options: Mapping[str, str]
) -> list[HeaderGroup]:
    """The files of one micro-batch, in order, by columns; files without a line drop out.

    The first line of a file tells its header. Headers that a line alone does not tell are
    left to Spark's reader, one file at a time.
    """
    ordered = [file for file in files if file.line is not None]
    distinct = list(dict.fromkeys(file.line for file in ordered))
    cells_of = dict(zip(distinct, header_cells(spark, distinct, options)))
    null_value = next((value for name, value in options.items() if name.lower() == "nullvalue"), "")
    case_sensitive = spark.conf.get("spark.sql.caseSensitive") == "true"
    quote = (options.get("quote") or '"').encode()
    by_columns: dict[tuple[str, ...], list[str]] = {}
    read: dict[bytes, tuple[str, ...]] = {}
    for file in ordered:
        line = file.line
        if cells_of[line] is not None:
            columns = safe_names(cells_of[line], null_value, case_sensitive)
        elif line in read:
            columns = read[line]
        else:
            sample = spark.read.options(**options).option("header", True).csv(literal_path(file.path))
            columns = tuple(sample.columns)
            if line.count(quote) % 2 == 0:
                read[line] = columns
        by_columns.setdefault(columns, []).append(file.path)
    return [HeaderGroup(columns, tuple(paths)) for columns, paths in by_columns.items()]


def fold_names(known: Sequence[str], columns: Sequence[str]) -> list[str]:
    """Names for ``columns``, taking the spelling in ``known`` where only the case differs.

    A name met twice in one header under different case keeps its own spelling and is told
    apart by its position, as Spark does for repeated names.
    """
    spelling = {name.lower(): name for name in reversed(known)}
    taken: set[str] = set()
    out = []
    for position, column in enumerate(columns):
        name = spelling.get(column.lower(), column)
        if name.lower() in taken:
            name = f"{column}{position}"
        taken.add(name.lower())
        out.append(name)
    return out


def read_by_name(
    spark: SparkSession,
    groups: Sequence[HeaderGroup],
    known: Sequence[str],
    options: Mapping[str, str],
    reserved: Iterable[str] = (),
) -> DataFrame:
    """All rows of the groups as text, columns matched by name, plus where each row came from.

    A line with more or fewer cells than its header fills what it can, and is kept whole too.
    """
    refused = {name.lower() for name in (*POSITION, METADATA, *reserved)}
    for group in groups:
        clash = sorted(name for name in group.columns if name.lower() in refused)
        if clash:
            raise HeaderError(f"reserved column names in the files: {clash}, such as in {group.paths[0]}")
    names = list(known)
    parts = []
    for group in groups:
        columns = fold_names(names, group.columns)
        names += [column for column in columns if column not in names]
        schema = T.StructType([T.StructField(column, T.StringType()) for column in (*columns, UNFIT)])
        rows = (
            spark.read.schema(schema)
            .options(**options)
            .option("header", True)
            .option("columnNameOfCorruptRecord", UNFIT)
            .csv([literal_path(path) for path in group.paths])
        )
        parts.append(
            rows.select(
                *quoted_all(columns),
                F.col("_metadata.file_modification_time").alias(FILE_TIME),
                F.col("_metadata.file_path").alias(SOURCE_FILE),
                F.col("_metadata.file_block_start").alias(BLOCK_START),
                F.monotonically_increasing_id().alias(ROW_ID),
                UNFIT,
            )
        )
    union = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)
    present = set(union.columns)
    return union.select(*[quoted(name) for name in names if name in present], *POSITION)
