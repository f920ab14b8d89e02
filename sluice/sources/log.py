"""Small append-only logs: one JSON file per entry, named by the entry's number.

An entry is one file, so it is there or it is not. Each log has one writer. The driver reads and
writes single entries itself, without a Spark job; the last one is found by its name.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T

WRITTEN_AT = "written_at"


class Log:
    """``key`` names the field of an entry that is its number."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str) -> None:
        self.spark = spark
        self.path = path
        self.key = key
        self.schema = T.StructType([*schema, T.StructField(WRITTEN_AT, T.TimestampType())])

    def numbers(self) -> list[int]:
        names = file_names(self.spark, self.path)
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))

    def read(self, number: int) -> Row:
        entry = json.loads(read_text(self.spark, self._file(number)))
        return Row(**{field.name: entry.get(field.name) for field in self.schema})

    def last(self) -> Row | None:
        numbers = self.numbers()
        return self.read(numbers[-1]) if numbers else None

    def between(self, after: int | None, upto: int | None) -> list[Row]:
        """Entries with a number in ``(after, upto]``; a bound left out is no bound."""
        return [
            self.read(number)
            for number in self.numbers()
            if (after is None or number > after) and (upto is None or number <= upto)
        ]

    def entries(self) -> DataFrame:
        """All entries; empty if nothing was ever written, while any error is raised."""
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("pathGlobFilter", "*.json").json(self.path)

    def append(self, entry: Mapping) -> None:
        stamped = {**entry, WRITTEN_AT: datetime.now(timezone.utc).isoformat()}
        write_text(self.spark, self._file(entry[self.key]), json.dumps(stamped))

    def _file(self, number: int) -> str:
        return f"{self.path}/{number:012d}.json"


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    settings = spark._jsparkSession.sessionState().newHadoopConf()
    return place, place.getFileSystem(settings)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, asked of the file system it lies in."""
    place, system = _place(spark, path)
    return system.exists(place)


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a directory, by one listing; none if it is not there."""
    place, system = _place(spark, path)
    if not system.exists(place):
        return []
    return [status.getPath().getName() for status in system.listStatus(place)]


def directory_sizes(spark: SparkSession, path: str, most: int) -> dict[str, int] | None:
    """Bytes in each directory of a directory by its name; None if there are more than ``most``."""
    place, system = _place(spark, path)
    found = [status.getPath() for status in system.listStatus(place) if status.isDirectory()]
    if len(found) > most:
        return None
    return {one.getName(): system.getContentSummary(one).getLength() for one in found}


def read_text(spark: SparkSession, path: str) -> str:
    place, system = _place(spark, path)
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Make a file that was not there, whole or not at all."""
    place, system = _place(spark, path)
    hidden, _ = _place(spark, f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}")
    stream = system.create(hidden, False)
    stream.write(text.encode())
    stream.close()
    if system.exists(place) or not system.rename(hidden, place):
        system.delete(hidden, False)
        raise FileExistsError(f"another writer has made {path}")
