"""A typed table that stands in for the one of the library: a whole snapshot for each load."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice import Dataset, Layout, upsert
from sluice.sources.log import Log
from sluice.sources.silver import SilverState

ENTRY = (
    T.StructType().add("load", "long").add("raw_version", "long").add("snapshot", "long")
    .add("keys", T.ArrayType(T.StringType())).add("schema", "string")
)


class SnapshotStore:
    """Every load writes all rows to a directory of its own; the last log entry names the current one."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root
        self.log = Log(spark, f"{root}/snapshots", ENTRY, key="load")

    def state(self) -> SilverState | None:
        last = self.log.last()
        if last is None:
            return None
        schema = T.StructType.fromJson(json.loads(last.schema))
        ever = {f.name.lower(): f.dataType.simpleString() for f in schema}
        return SilverState(last.load, last.raw_version, 1, list(last["keys"]), schema, last.snapshot, ever=ever)

    def has_rows(self, state: SilverState | None) -> bool:
        return state is not None

    def exists(self) -> bool:
        return self.has_rows(self.state())

    def read(self) -> DataFrame:
        state = self.state()
        if state is None:
            raise ValueError(f"{self.root} holds no table")
        return self.spark.read.schema(state.schema).parquet(self._place(state.base_load))

    def view_sql(self) -> str | None:
        state = self.state()
        if state is None:
            return None
        names = ", ".join(f"`{name}`" for name in state.schema.names)
        return f"SELECT {names} FROM parquet.`{self._place(state.base_load)}`"

    def write_full(
        self, state: SilverState | None, rows: DataFrame, keys: Sequence[str], raw_version: int, size: int,
        shuffled_by_key: bool, check: Callable[[], None],
    ) -> int:
        return self._publish(state, rows, rows.schema, keys, raw_version, check)

    def merge(
        self, state: SilverState, rows: DataFrame, keys: Sequence[str], raw_version: int, keep: Sequence[str],
        shuffled_by_key: bool, check: Callable[[], None],
    ) -> int:
        there = set(state.schema.names)
        old = self.read().select(
            *[F.col(f.name) if f.name in there else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema]
        )
        counted = Observation()
        counting = rows.observe(counted, F.count(F.lit(1)).alias("rows"))
        self._publish(state, upsert(old, counting, keys, keep), rows.schema, keys, raw_version, check)
        return counted.get["rows"]

    def log_empty(self, state: SilverState, raw_version: int) -> None:
        self._log(state.load + 1, raw_version, state.base_load, state.keys, state.schema)

    def _publish(self, state, rows, schema, keys, raw_version, check) -> int:
        load = 0 if state is None else state.load + 1
        counted = Observation()
        rows.observe(counted, F.count(F.lit(1)).alias("all")).write.mode("overwrite").parquet(self._place(load))
        check()
        self._log(load, raw_version, load, keys, schema)
        return counted.get["all"]

    def _log(self, load: int, raw_version: int, snapshot: int, keys: Sequence[str], schema: T.StructType) -> None:
        entry = {"load": load, "raw_version": raw_version, "snapshot": snapshot, "keys": list(keys)}
        self.log.append({**entry, "schema": schema.json()})

    def _place(self, load: int) -> str:
        return f"{self.root}/snapshot={load}"


def snapshot_store(spark: SparkSession, dataset: Dataset, layout: Layout) -> SnapshotStore:
    return SnapshotStore(spark, layout.typed_of(dataset))
