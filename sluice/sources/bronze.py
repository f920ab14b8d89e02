"""The raw table: append-only, all text, one directory per commit version.

``<root>/data/_commit_version=<n>/`` holds the rows and ``<root>/commits/`` an entry for each
version. A version counts once its entry is there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.changes import CHANGE_TYPE, COMMIT_TIMESTAMP, COMMIT_VERSION, FEED_COLUMNS, INSERT
from sluice.sources.csv_files import (
    BLOCK_START,
    FILE_TIME,
    METADATA,
    POSITION,
    ROW_ID,
    SOURCE_FILE,
    UNFIT,
    literal_path,
)
from sluice.sources.log import Log, path_exists

RESERVED = frozenset([*FEED_COLUMNS, *POSITION, METADATA])

COMMIT = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("stream_id", T.StringType()),
        T.StructField("files", T.LongType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField("columns", T.ArrayType(T.StringType())),
        T.StructField("known_columns", T.ArrayType(T.StringType())),
        T.StructField("known_bytes", T.LongType()),
    ]
)


class LostCheckpointError(RuntimeError):
    """A new stream, counting from zero again, meets versions an earlier stream wrote."""


class BronzeTable:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.data = f"{self.root}/data"
        self.log = Log(spark, f"{self.root}/commits", COMMIT, key="version")

    # -- state ---------------------------------------------------------------------------

    def commits(self) -> DataFrame:
        return self.log.entries()

    def head(self) -> Row | None:
        """The last commit; ``known_columns`` and ``known_bytes`` are of all versions so far."""
        return self.log.last()

    def latest_version(self) -> int | None:
        """The last committed version, None if the table does not exist yet."""
        head = self.head()
        return None if head is None else head.version

    def exists(self) -> bool:
        return self.head() is not None

    def known_columns(self) -> list[str]:
        """Raw columns of the table, in order of first appearance."""
        head = self.head()
        return [] if head is None else list(head.known_columns)

    def window(self, after: int | None, upto: int | None) -> list[Row]:
        """Commit entries of the versions in ``(after, upto]``."""
        return self.log.between(after, upto)

    def columns(self, after: int | None, upto: int | None) -> list[str]:
        """Raw columns that some version in ``(after, upto]`` has."""
        return sorted({name for entry in self.window(after, upto) for name in entry.columns})

    # -- writing -------------------------------------------------------------------------

    def write_version(self, rows: DataFrame, version: int, stream_id: str, files: int = 0, size: int = 0) -> None:
        """Write one version and commit it; a replay of a committed version does nothing.

        A version left without its commit entry is written over by the replay.
        """
        head = self.head()
        if head is not None:
            if head.stream_id != stream_id:
                raise LostCheckpointError(
                    f"{self.root} holds versions of stream {head.stream_id}, not {stream_id}: "
                    "restore its checkpoint or use a fresh raw table"
                )
            if head.version >= version:
                return
        columns = [name for name in rows.columns if name not in POSITION]
        known = [] if head is None else list(head.known_columns)
        clash = RESERVED.intersection(name.lower() for name in columns)
        if clash:
            raise ValueError(f"reserved column names in the files: {sorted(clash)}")
        counted = Observation()
        stamped = rows.withColumn(COMMIT_TIMESTAMP, F.current_timestamp()).observe(
            counted, F.count(F.lit(1)).alias("rows")
        )
        stamped.write.mode("overwrite").parquet(f"{self.data}/{COMMIT_VERSION}={version}")
        self.log.append(
            {
                "version": version,
                "stream_id": stream_id,
                "files": files,
                "bytes": size,
                "rows": counted.get["rows"],
                "columns": columns,
                "known_columns": [*known, *(name for name in columns if name not in known)],
                "known_bytes": size + (0 if head is None else head.known_bytes),
            }
        )

    # -- reading -------------------------------------------------------------------------

    def _schema(self, head: Row | None) -> T.StructType:
        """All raw columns as text. Known from the commits, so no file footer is merged."""
        head = head or self.head()
        text = [T.StructField(name, T.StringType()) for name in head.known_columns]
        return T.StructType(
            [
                *text,
                T.StructField(FILE_TIME, T.TimestampType()),
                T.StructField(SOURCE_FILE, T.StringType()),
                T.StructField(BLOCK_START, T.LongType()),
                T.StructField(ROW_ID, T.LongType()),
                T.StructField(UNFIT, T.StringType()),
                T.StructField(COMMIT_TIMESTAMP, T.TimestampType()),
                T.StructField(COMMIT_VERSION, T.LongType()),
            ]
        )

    def read_upto(self, upto: int, head: Row | None = None) -> DataFrame:
        """Every row of the versions up to and including ``upto``; ``head`` if it is at hand."""
        table = self.spark.read.schema(self._schema(head)).parquet(literal_path(self.data))
        return table.filter(F.col(COMMIT_VERSION) <= upto)

    def read_changes(self, after: int, upto: int, head: Row | None = None) -> DataFrame:
        """Feed rows of the versions in ``(after, upto]``; only their directories are listed."""
        versions = [number for number in self.log.numbers() if after < number <= upto]
        paths = [literal_path(f"{self.data}/{COMMIT_VERSION}={version}") for version in versions]
        schema = self._schema(head)
        if paths:
            rows = self.spark.read.schema(schema).option("basePath", self.data).parquet(*paths)
        else:
            rows = self.spark.createDataFrame([], schema)
        return between(rows, COMMIT_VERSION, after, upto).withColumn(CHANGE_TYPE, F.lit(INSERT))

    def assert_versioned(self, head: Row | None = None) -> None:
        """Fail unless rows can be told by version: the last commit has its directory."""
        head = head or self.head()
        if head is None:
            raise ValueError(f"{self.root} has no commits")
        if head.rows and not path_exists(self.spark, f"{self.data}/{COMMIT_VERSION}={head.version}"):
            raise ValueError(f"{self.root} lacks the rows of version {head.version}")


def between(df: DataFrame, column: str, after: int | None, upto: int | None) -> DataFrame:
    """Rows whose ``column`` lies in ``(after, upto]``; a bound left out is no bound."""
    if after is not None:
        df = df.filter(F.col(column) > after)
    if upto is not None:
        df = df.filter(F.col(column) <= upto)
    return df
