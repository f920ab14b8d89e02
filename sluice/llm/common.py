"""What the operators share: the scratch folder, shipping this library to executors, white space."""

from __future__ import annotations

import ctypes
import os
import sys
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The characters that part words, as a class body for Java, Python and RE2 patterns.
SPACES = "\\x20\\x09-\\x0D"
#: A word.
WORD = f"[^{SPACES}]+"


def quoted(name: str) -> Column:
    """The column of exactly this name, whatever signs it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def scratch(spark: SparkSession, what: str) -> str:
    """A new folder in the shared folder of the cluster (`spark.checkpoint.dir`).

    Only a local master may do without that setting: it gets a temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", "")
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir names no shared folder")
        shared = "file:" + tempfile.mkdtemp(prefix="llm-")
    return f"{shared.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str, group_rows: int | None = None) -> DataFrame:
    """The rows, computed once and kept as a table in the shared folder; cuts the lineage.

    `group_rows` bounds the rows of a Parquet row group, for rows of some MB each: a reader holds a
    whole group.
    """
    spark = df.sparkSession
    path = scratch(spark, what)
    options = {"parquet.block.row.count.limit": group_rows} if group_rows else {}
    with small_batches(spark):
        df.write.options(compression="zstd", **options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of a batch of rows that Spark hands to Python.
BATCH_BYTES = 16 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Hand rows of long texts to Python in batches of bounded size; restores the setting."""
    before = spark.conf.get(_BATCH_SETTING)
    spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_SETTING, before)


def give_back() -> None:
    """Return freed memory of this Python worker, which lives on, to the machine."""
    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not on every platform
    if trim:
        trim(0)


def ship(spark: SparkSession) -> None:
    """Give the executors this library, so that functions run there import it by name.

    Needed where it is not installed on the machines. Does so once per Spark application.
    """
    context = spark.sparkContext
    if getattr(context, "_sluice_shipped", False):
        return
    root = Path(__file__).resolve().parent.parent
    archive = os.path.join(tempfile.mkdtemp(prefix="ship-"), "sluice_library.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, str(path.relative_to(root.parent)))
    known = list(sys.path)
    context.addPyFile(archive)
    sys.path[:] = known  # the driver keeps using the library it has
    context._sluice_shipped = True


def first_by_hash(df: DataFrame, group: str, order: str, rows: int, groups: int) -> DataFrame:
    """At most `rows` rows of each group, those with the least values of `order`, a 64-bit hash.

    Groups are counted first, so that about eight times as many rows as are wanted get as far as
    the window. Of more than `groups` groups those with the most rows are taken, ties by value.
    """
    counted = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    counts = counted.orderBy(F.desc("n"), group).limit(groups).collect()
    likely = F.lit(False)
    for value, n in counts:
        here = F.col(group).eqNullSafe(F.lit(value))
        if n > 8 * rows:
            here &= F.col(order) < F.lit((8 * rows << 64) // n - (1 << 63))
        likely |= here
    place = Window.partitionBy(group).orderBy(order, *[F.col(c) for c in df.columns if c not in (group, order)])
    ranked = df.filter(likely).withColumn("_place", F.row_number().over(place))
    return ranked.filter(F.col("_place") <= rows).drop("_place")


#: Rows of a few numbers and short texts that are sent to every task, at most.
BROADCAST_ROWS = 300_000


def small(table: DataFrame, rows: int | None = None) -> DataFrame:
    """A written table, to be sent to every task if it has at most `rows` rows; else Spark shuffles."""
    most = BROADCAST_ROWS if rows is None else rows
    return F.broadcast(table) if table.count() <= most else table


def without(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of `docs` but those whose id and hash of text are in `gone` (doc, content).

    `gone` is sent to every task if it has few rows, else both sides are shuffled by their ids.
    """
    text = F.xxhash64(quoted(text_col).cast("string"))
    gone = small(written(gone, "gone"))
    named = gone.select(F.struct(F.col("doc").alias("id"), F.col("content").alias("text")).alias("gone"))
    row = F.struct(*[quoted(c) for c in docs.columns]).alias("row")
    rows = docs.select(row, quoted(id_col).alias("id"), text.alias("text"))
    same = F.col("id").eqNullSafe(F.col("gone.id")) & (F.col("text") == F.col("gone.text"))
    return rows.join(named, same, "left_anti").select("row.*")


#: Bits of a bitmap (512 KB), which every task of a scan gets.
BITS = 1 << 22


def _slot(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BITS))


def bitmap(keys: DataFrame) -> DataFrame:
    """One row: an array of `BITS` bits, as longs, with those of the values of the only column set."""
    slots = keys.select(_slot(quoted(keys.columns[0])).alias("slot"))
    bit = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    words = slots.groupBy(F.shiftright("slot", 6).alias("id")).agg(F.bit_or(bit).alias("bits"))
    every = keys.sparkSession.range(BITS // 64).join(words, "id", "left")
    listed = F.sort_array(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0)).alias("bits"))))
    return written(every.agg(listed["bits"].alias("bitmap")), "bitmap")


def in_bitmap(key: Column, made: DataFrame) -> Column:
    """False only for values that are not in it; true for them too by the share of bits that are set.

    For a filter before a join, so that the rows that have no partner need not move.
    """
    slot = _slot(key)
    word = F.get(made.scalar(), F.shiftright(slot, 6).cast("int"))
    return F.getbit(word, slot.bitwiseAND(F.lit(63)).cast("int")) == 1
