"""The typed table: Parquet in key buckets, of which a load rewrites only the touched ones.

``<root>/data/_load=<n>/_bucket=<b>/`` holds the rows and ``<root>/loads/`` an entry for each
load, which is its commit: rows and merged raw version become visible together. The last entry
tells, for every bucket, which load holds its rows. Rows with a NULL in the key match nothing:
they sit in bucket -1, to which loads add; now and then a load puts them together.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.columns import any_null, quoted, quoted_all
from sluice.operators.upsert import keep_values, unmatched
from sluice.sources.csv_files import literal_path
from sluice.sources.log import Log, directory_sizes, path_exists

LOAD = "_load"
BUCKET = "_bucket"
LOOSE = -1
RESERVED = frozenset([LOAD, BUCKET])

#: Bytes of Parquet in a bucket, about.
BUCKET_BYTES = 256 << 20
MAX_BUCKETS = 1 << 14
GROWTH = 4  # buckets are recounted once the table calls for this many times more

PLACE = T.StructType(
    [
        T.StructField("bucket", T.IntegerType()),
        T.StructField("load", T.LongType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("of", T.IntegerType()),
    ]
)
ENTRY = T.StructType(
    [
        T.StructField("load", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("raw_version", T.LongType()),
        T.StructField("rows_in", T.LongType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("written", T.ArrayType(T.IntegerType())),
        T.StructField("keys", T.ArrayType(T.StringType())),
        T.StructField("schema", T.StringType()),
        T.StructField("since", T.MapType(T.StringType(), T.LongType())),
        T.StructField("ever", T.MapType(T.StringType(), T.StringType())),
        T.StructField("base_load", T.LongType()),
        T.StructField("places", T.ArrayType(PLACE)),
    ]
)

FULL = "full"
MERGE = "merge"
EMPTY = "empty"


@dataclass(frozen=True)
class Place:
    """Rows of a bucket: the load that wrote them, their bytes, and how many buckets it wrote."""

    bucket: int
    load: int
    bytes: int
    of: int


@dataclass(frozen=True)
class SilverState:
    """What the last log entry says.

    ``base_load`` is the full load the table builds on. A column's values count from the load
    ``since`` which it is in the contract; ``ever`` holds the type of each name that ever was.
    """

    load: int
    raw_version: int
    buckets: int
    keys: list[str]
    schema: T.StructType
    base_load: int
    since: Mapping[str, int] = field(default_factory=dict)
    ever: Mapping[str, str] = field(default_factory=dict)
    places: tuple[Place, ...] = ()

    @property
    def bytes(self) -> int:
        return sum(place.bytes for place in self.places)


#: Keys of a merge that are broadcast at once take at most this part of the driver's heap, which holds
#: them several times over; more of them are broadcast slice by slice, those of more slices shuffled.
HEAP_PART = 16
SLICES = 32


@dataclass(frozen=True)
class Slice:
    """What one write of a merge takes: all, some buckets, or a part of a bucket's keys by their hash."""

    buckets: tuple[int, ...] | None = None
    part: int = 0
    of: int = 1

    def rows(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        some = df if self.buckets is None else df.filter(F.col(BUCKET).isin(*self.buckets))
        return some if self.of == 1 else some.filter(F.pmod(F.xxhash64(*quoted_all(keys)), F.lit(self.of)) == self.part)


def key_slices(shares: Mapping[int, float], most: float) -> list[Slice]:
    """Buckets put together up to ``most`` bytes of keys; a bucket with more is cut."""
    together: list[Slice] = []
    cut: list[Slice] = []
    held: list[int] = []
    size = 0.0
    for bucket, share in sorted(shares.items()):
        if share > most:
            parts = math.ceil(share / most)
            cut += [Slice((bucket,), part, parts) for part in range(parts)]
            continue
        if held and size + share > most:
            together.append(Slice(tuple(held)))
            held, size = [], 0.0
        held.append(bucket)
        size += share
    return [*together, *([Slice(tuple(held))] if held else []), *cut]


def bucket_count(size: int, tasks: int, bucket_bytes: int) -> int:
    """Buckets for a table of about ``size`` bytes, at most twice as many as it calls for.

    A multiple or a divisor of the shuffle width, if one is near: then each shuffle task of a
    load holds whole buckets, or parts of a single one.
    """
    wanted = min(MAX_BUCKETS, max(1, math.ceil(size / bucket_bytes)))
    fitting = (n for n in range(wanted, min(MAX_BUCKETS, 2 * wanted) + 1) if n % tasks == 0 or tasks % n == 0)
    return next(fitting, wanted)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Bucket of a row: the hash a shuffle on the keys uses; rows with a NULL key go apart."""
    hashed = F.pmod(F.hash(*quoted_all(keys)), F.lit(buckets))
    return F.when(any_null(keys), F.lit(LOOSE)).otherwise(hashed).cast("int").alias(BUCKET)


def in_buckets(place: str, buckets: Sequence[int]) -> str:
    """Some bucket directories as one pattern: a path for each is looked up by the driver, one by one."""
    return f"{literal_path(place)}/{BUCKET}={{{','.join(map(str, buckets))}}}"


#: Directories that the driver lists itself, at most; as many as Spark's own listing does without a job.
FEW = 32


def bucket_sizes(spark: SparkSession, place: str) -> dict[int, int]:
    """Bytes of each bucket in the directory of a load.

    Where there are more than a few, Spark lists the files, in tasks, and two numbers a file come to
    the driver.
    """
    sign = f"{BUCKET}="
    few = directory_sizes(spark, place, FEW)
    if few is not None:
        return {int(name.removeprefix(sign)): size for name, size in few.items() if name.startswith(sign)}
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    bucket = F.regexp_extract("path", f"/{sign}(-?[0-9]+)/[^/]*$", 1).cast("int")
    found: dict[int, int] = {}
    for row in files.load(literal_path(place)).select(bucket.alias("bucket"), "length").collect():
        found[row.bucket] = found.get(row.bucket, 0) + row.length
    return found


def nothing_to_check() -> None:
    pass


class SilverTable:
    def __init__(
        self, spark: SparkSession, root: str, compact_every: int = 16, bucket_bytes: int | None = None
    ) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.data = f"{self.root}/data"
        self.compact_every = compact_every
        self.bucket_bytes = bucket_bytes or BUCKET_BYTES
        self.log = Log(spark, f"{self.root}/loads", ENTRY, key="load")

    # -- state ---------------------------------------------------------------------------

    def loads(self) -> DataFrame:
        return self.log.entries()

    def state(self) -> SilverState | None:
        """The last load, None before the first one."""
        last = self.log.last()
        if last is None:
            return None
        return SilverState(
            last.load,
            last.raw_version,
            last.buckets,
            list(last["keys"]),
            T.StructType.fromJson(json.loads(last.schema)),
            last.base_load,
            dict(last.since),
            dict(last.ever),
            tuple(Place(**place) for place in last.places),
        )

    def exists(self) -> bool:
        """Whether there are rows to read: the log alone does not make a table."""
        return self.has_rows(self.state())

    def has_rows(self, state: SilverState | None) -> bool:
        return state is not None and path_exists(self.spark, self._place(state.base_load))

    # -- reading -------------------------------------------------------------------------

    def read(self) -> DataFrame:
        state = self.state()
        if not self.has_rows(state):
            raise ValueError(f"{self.root} holds no table")
        return self._read(state, state.schema, state.since).select(*quoted_all(state.schema.names))

    def view_sql(self) -> str | None:
        """The current rows as a query on their directories, None if there are none."""
        state = self.state()
        if not self.has_rows(state):
            return None

        def mark(name: str) -> str:
            return "`" + name.replace("`", "``") + "`"

        parts = []
        for load, places in self._by_load(state.places).items():
            columns = [
                mark(f.name)
                if state.since[f.name] <= load
                else f"CAST(NULL AS {f.dataType.simpleString()}) AS {mark(f.name)}"
                for f in state.schema
            ]
            buckets = ", ".join(str(place.bucket) for place in places)
            where = "" if len(places) == places[0].of else f" WHERE {BUCKET} IN ({buckets})"
            parts.append(f"SELECT {', '.join(columns)} FROM parquet.{mark(self._place(load))}{where}")
        return " UNION ALL ".join(parts)

    @staticmethod
    def _by_load(places: Sequence[Place]) -> dict[int, list[Place]]:
        by_load: dict[int, list[Place]] = {}
        for place in sorted(places, key=lambda place: (place.load, place.bucket)):
            by_load.setdefault(place.load, []).append(place)
        return by_load

    def _read(
        self,
        state: SilverState,
        schema: T.StructType,
        since: Mapping[str, int],
        buckets: Sequence[int] | None = None,
    ) -> DataFrame:
        """The current rows, or those of some buckets, with their bucket.

        What a load wrote is read with the columns that count since then; others are NULL, also
        if an earlier column of that name is still in its files.
        """
        wanted = None if buckets is None else set(buckets)
        places = [place for place in state.places if wanted is None or place.bucket in wanted]
        paths: dict[tuple[str, ...], list[str]] = {}
        for load, some in self._by_load(places).items():
            visible = tuple(name for name in schema.names if since.get(name, 0) <= load)
            place = self._place(load)
            everything = len(some) == some[0].of  # all the load wrote
            path = literal_path(place) if everything else in_buckets(place, [part.bucket for part in some])
            paths.setdefault(visible, []).append(path)
        full = _bucketed(schema)
        parts = []
        for visible, some in paths.items():
            fields = [f for f in schema if f.name in visible]
            read = T.StructType([*fields, T.StructField(LOAD, T.LongType()), T.StructField(BUCKET, T.IntegerType())])
            rows = self.spark.read.schema(read).option("basePath", self.data).parquet(*some)
            columns = [
                quoted(f.name) if f.name in visible else F.lit(None).cast(f.dataType).alias(f.name) for f in schema
            ]
            parts.append(rows.select(*columns, BUCKET))
        if not parts:
            return self.spark.createDataFrame([], full)
        return reduce(DataFrame.unionByName, parts)

    def superseded(self) -> DataFrame:
        """Directories of logged loads that the table no longer reads, free to be removed."""
        state = self.state()
        if state is None:
            return self.spark.createDataFrame([], "path string")
        written = self.loads().select("load", F.explode("written").alias("bucket"))
        current = self.spark.createDataFrame(
            [(place.load, place.bucket) for place in state.places], "load long, bucket int"
        )
        old = written.join(current, ["load", "bucket"], "left_anti")
        path = F.concat(F.lit(f"{self.data}/{LOAD}="), "load", F.lit(f"/{BUCKET}="), "bucket")
        return old.select(path.alias("path"))

    # -- writing -------------------------------------------------------------------------

    def _tasks(self) -> int:
        """Width of a shuffle, before AQE puts neighbours together."""
        initial = self.spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
        return int(initial or self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _write(self, tables: Iterable[DataFrame], place: str) -> dict[int, int]:
        """Write buckets; what a load that failed left there goes first. Bytes of each bucket."""
        for number, rows in enumerate(tables):
            writer = rows.write.mode("append" if number else "overwrite")
            writer.option("partitionOverwriteMode", "static").partitionBy(BUCKET).parquet(place)
        return bucket_sizes(self.spark, place)

    def _by_bucket(self, rows: DataFrame, keys: Sequence[str], buckets: int, shuffled_by_key: bool) -> DataFrame:
        """Add the bucket, with the rows of one bucket in few tasks, so a write makes few files.

        Rows that come out of a shuffle on the keys already are, if the bucket count fits it.
        """
        placed = rows.withColumn(BUCKET, bucket_of(keys, buckets))
        tasks = self._tasks()
        if shuffled_by_key and (buckets % tasks == 0 or tasks % buckets == 0):
            return placed
        return placed.hint("rebalance", BUCKET)

    def write_full(
        self,
        state: SilverState | None,
        rows: DataFrame,
        keys: Sequence[str],
        raw_version: int,
        size: int,
        shuffled_by_key: bool = False,
        check: Callable[[], None] = nothing_to_check,
    ) -> int:
        """Make ``rows`` the table, in one write. ``size`` is about what they will take as Parquet.

        ``check`` runs after the rows are written and before they count.
        """
        load = 0 if state is None else state.load + 1
        buckets = bucket_count(size, self._tasks(), self.bucket_bytes)
        counted = Observation()
        placed = self._by_bucket(rows, keys, buckets, shuffled_by_key)
        sizes = self._write([placed.observe(counted, F.count(F.lit(1)).alias("rows"))], self._place(load))
        check()
        count = counted.get["rows"]
        made = SilverState(load, raw_version, buckets, list(keys), rows.schema, base_load=load)
        self._commit(self._with_columns(made, state, load), FULL, count, sizes, ())
        return count

    def merge(
        self,
        state: SilverState,
        rows: DataFrame,
        keys: Sequence[str],
        raw_version: int,
        keep: Sequence[str] = (),
        shuffled_by_key: bool = False,
        check: Callable[[], None] = nothing_to_check,
    ) -> int:
        """Upsert ``rows``, each key at most once, into the buckets they fall in.

        The rows are written to a staging place first: they feed the bucket list, the join and
        the new buckets, and a lost executor then costs no recomputation. Keys to be broadcast that
        the driver should not hold at once go slice by slice, a write each. A table that has
        outgrown its buckets is written anew with more of them; its size is what its files
        take, and at most what the new rows add.
        """
        staged, touched, counts = self._stage(rows, keys, state.buckets, shuffled_by_key)
        check()
        buckets = bucket_count(state.bytes + sum(touched.values()), self._tasks(), self.bucket_bytes)
        grown = buckets >= GROWTH * state.buckets

        load = state.load + 1
        made = replace(state, load=load, raw_version=raw_version, keys=list(keys), schema=rows.schema)
        made = self._with_columns(made, state, load)
        loose = [place for place in state.places if place.bucket == LOOSE]
        gather = bool(self.compact_every) and len(loose) >= self.compact_every
        others = [place.bucket for place in state.places] if grown else []
        slices, join = self._slices(touched, others, counts["key_bytes"] or 0)

        def old(wanted: Sequence[int] | None) -> DataFrame:
            return self._read(state, rows.schema, made.since, wanted)

        def merged(some: Slice) -> DataFrame:
            here = [bucket for bucket in some.buckets or touched if bucket != LOOSE]
            target = old(None if grown and some.buckets is None else here)
            whole = some.rows(target.filter(F.col(BUCKET) != LOOSE), keys)  # by directory; a loose row has no match
            new = some.rows(staged, keys)
            wanted = new.select(*quoted_all(keys))
            incoming = keep_values(whole, new, keys, keep) if keep else new
            result = unmatched(whole, wanted.hint(join) if join else wanted, keys).unionByName(incoming)
            if grown:
                result = self._by_bucket(result.drop(BUCKET), keys, buckets, shuffled_by_key=False)
            if (grown or gather) and some is slices[0]:
                result = result.unionByName(old([LOOSE]))
            if not grown and (gather or self.compact_every and load % self.compact_every == 0):
                # A shuffle-free merge adds a file per bucket; now and then put them together.
                result = result.hint("rebalance", BUCKET)
            return result

        sizes = self._write(map(merged, slices), self._place(load))
        if grown:
            made = replace(made, buckets=buckets, base_load=load)
        replaced = {bucket for bucket in touched if bucket != LOOSE} | ({LOOSE} if gather else set())
        kept = [] if grown else [place for place in state.places if place.bucket not in replaced]
        self._commit(made, FULL if grown else MERGE, counts["rows"], sizes, kept)
        return counts["rows"]

    def log_empty(self, state: SilverState, raw_version: int) -> None:
        """Note versions that held no rows, so they are not looked at again."""
        made = replace(state, load=state.load + 1, raw_version=raw_version)
        self._commit(made, EMPTY, 0, {}, state.places)

    @staticmethod
    def _with_columns(made: SilverState, state: SilverState | None, load: int) -> SilverState:
        """With the loads since which the columns count, and the types of all there ever were."""
        old = set() if state is None else set(state.schema.names)
        since = {name: state.since.get(name, 0) if name in old else load for name in made.schema.names}
        ever = {} if state is None else dict(state.ever)
        ever |= {f.name.lower(): f.dataType.simpleString() for f in made.schema}
        return replace(made, since=since, ever=ever)

    def _commit(
        self, made: SilverState, kind: str, rows_in: int, sizes: Mapping[int, int], kept: Sequence[Place]
    ) -> None:
        written = [Place(bucket, made.load, size, len(sizes)) for bucket, size in sorted(sizes.items())]
        self.log.append(
            {
                "load": made.load,
                "kind": kind,
                "raw_version": made.raw_version,
                "rows_in": rows_in,
                "buckets": made.buckets,
                "written": sorted(sizes),
                "keys": made.keys,
                "schema": made.schema.json(),
                "since": dict(made.since),
                "ever": dict(made.ever),
                "base_load": made.base_load,
                "places": [vars(place) for place in (*kept, *written)],
            }
        )

    def _place(self, load: int) -> str:
        return f"{self.data}/{LOAD}={load}"

    def _stage(
        self, rows: DataFrame, keys: Sequence[str], buckets: int, shuffled_by_key: bool
    ) -> tuple[DataFrame, dict[int, int], dict]:
        """The rows in a staging place by bucket, the bytes of each bucket, and their counts."""
        place = f"{self.root}/staged"  # of one load; the next one overwrites it
        counted = Observation()
        placed = self._by_bucket(rows, keys, buckets, shuffled_by_key).observe(
            counted,
            F.count(F.lit(1)).alias("rows"),
            F.sum(_key_bytes(rows.schema, keys)).alias("key_bytes"),
        )
        sizes = self._write([placed], place)
        return self.spark.read.schema(_bucketed(rows.schema)).parquet(literal_path(place)), sizes, counted.get

    def _slices(
        self, touched: Mapping[int, int], others: Sequence[int], key_bytes: int
    ) -> tuple[list[Slice], str]:
        """Slices to be written one after the other, and the hint of their joins.

        Keys of a measured size within the limit for broadcasts are broadcast, each slice's by
        itself. Of others Spark decides, but for so many that the driver could not hold them.
        """
        at_once = self.spark._jvm.java.lang.Runtime.getRuntime().maxMemory() // HEAP_PART
        if key_bytes > min(self._broadcast_limit(), SLICES * at_once):
            return [Slice()], "merge" if key_bytes > at_once else ""
        if key_bytes <= at_once:
            return [Slice()], "broadcast"
        whole = sum(size for bucket, size in touched.items() if bucket != LOOSE)
        shares = {bucket: key_bytes * size / max(1, whole) for bucket, size in touched.items() if bucket != LOOSE}
        return key_slices(dict.fromkeys([*others, *touched], 0) | shares, at_once), "broadcast"

    def _broadcast_limit(self) -> int:
        threshold = self.spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        digits = threshold.lower().removesuffix("b")
        scale = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(digits[-1], 1)
        return int(digits.rstrip("kmg")) * scale


def _bucketed(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema, T.StructField(BUCKET, T.IntegerType())])


def _key_bytes(schema: T.StructType, keys: Sequence[str]) -> Column:
    """In-memory size of a row's key, rounded up: text by its length, other types 16 bytes."""
    size = F.lit(32)
    for name in keys:
        column = quoted_all([name])[0]
        text = isinstance(schema[name].dataType, T.StringType)
        size = size + (F.coalesce(F.octet_length(column), F.lit(0)) + 8 if text else F.lit(16))
    return size.cast("long")
