"""Landing directory to raw table, as a run-to-completion stream."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sluice.sources.bronze import RESERVED, BronzeTable
from sluice.sources.csv_files import (
    FEW_LISTING_TASKS,
    header_groups,
    literal_path,
    new_files,
    own_session,
    read_by_name,
)
from sluice.sources.headers import landed_files

STREAM_ID = "sql.streaming.queryId"

# Files of one micro-batch, whose names the driver holds.
MAX_FILES = 10_000

# A century: no late file is passed over on account of its age.
KEEP_ALL = "36500d"


def start_ingest(
    spark: SparkSession,
    landing: str,
    root: str,
    checkpoint: str,
    options: Mapping[str, str] | None = None,
    max_files: int = MAX_FILES,
    max_file_age: str = KEEP_ALL,
    cleaning: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Start a stream that appends every file not seen before, then stops.

    Each micro-batch takes at most ``max_files`` files and becomes one version. The checkpoint
    remembers the files, so a file is taken once, also if it is rewritten in place. ``cleaning``
    as in ``new_files``.
    """
    csv_options = dict(options or {})

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        stream_id = session.sparkContext.getLocalProperty(STREAM_ID)
        if stream_id is None:
            raise RuntimeError("the stream's id is not known to this thread: Python threads must be pinned")
        take_up(session, BronzeTable(session, root), batch_id, stream_id, batch, csv_options)

    return (
        new_files(spark, landing, max_files, max_file_age, cleaning)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def take_up(
    session: SparkSession,
    bronze: BronzeTable,
    version: int,
    stream_id: str,
    batch: DataFrame,
    options: Mapping[str, str],
) -> None:
    """Write the rows of some files (path, length, uri) as one version; files without a line make none."""
    files = landed_files(batch, options, literal_path)  # at most max_files
    groups = header_groups(session, files, options)
    if groups:
        rows = read_by_name(session, groups, bronze.known_columns(), options, RESERVED)
        size = sum(file.length for file in files)
        bronze.write_version(rows, version, stream_id, files=len(files), size=size)


def ingest(
    spark: SparkSession,
    landing: str,
    root: str,
    checkpoint: str,
    options: Mapping[str, str] | None = None,
    max_files: int = MAX_FILES,
    max_file_age: str = KEEP_ALL,
    cleaning: Mapping[str, str] | None = None,
) -> None:
    """Take up all new files and wait until they are committed."""
    session = own_session(spark, FEW_LISTING_TASKS)
    start_ingest(session, landing, root, checkpoint, options, max_files, max_file_age, cleaning).awaitTermination()
