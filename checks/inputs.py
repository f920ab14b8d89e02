"""Raw inputs made from the given tables, and contracts for them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice import Contract, Dataset, Field, Layout

DATE_FORMAT = "dd/MM/yyyy"
STAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_root(spark: SparkSession) -> str:
    """A new directory in the shared folder of the cluster; a local one on a local master only."""
    shared = spark.conf.get("spark.checkpoint.dir", "")
    if shared:
        return f"{shared.rstrip('/')}/run-{uuid.uuid4().hex}"
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("spark.checkpoint.dir names no shared folder")
    return f"file:{tempfile.mkdtemp(prefix='run-')}"


def money(column: str, scale: int = 2, precision: int = 12) -> Column:
    return F.col(column).cast(f"decimal({precision},{scale})")


def as_text(df: DataFrame, date_format: str = DATE_FORMAT) -> DataFrame:
    """Every column as text, timestamps in the given format."""
    columns = []
    for field in df.schema.fields:
        value = F.col(field.name)
        if field.dataType.typeName().startswith("timestamp"):
            value = F.date_format(value, date_format)
        columns.append(value.cast("string").alias(field.name))
    return df.select(*columns)


ORDERS = Contract(
    (
        Field("o_orderkey", "long", nullable=False, is_primary_key=True),
        Field("o_custkey", "long", nullable=False),
        Field("o_orderstatus", "string"),
        Field("o_totalprice", "decimal(12,2)"),
        Field("o_orderdate", "date", date_formats=(DATE_FORMAT,)),
        Field("o_orderpriority", "string"),
    )
)

CUSTOMER = Contract(
    (
        Field("c_custkey", "long", nullable=False, is_primary_key=True),
        Field("c_name", "string", nullable=False),
        Field("c_nationkey", "integer"),
        Field("c_acctbal", "decimal(10,2)"),
        Field("c_mktsegment", "string"),
    )
)

EVENTS = Contract(
    (
        Field("event_id", "long", nullable=False, is_primary_key=True),
        Field("ts", "timestamp", date_formats=("dd/MM/yyyy HH:mm:ss.SSSSSS", "yyyyMMdd HHmmss.SSSSSS")),
        Field("user_id", "long"),
        Field("event_type", "string"),
        Field("value", "decimal(4,2)", nullable=False),
    )
)

LINES = Contract(
    (
        Field("l_orderkey", "long", nullable=False, is_primary_key=True),
        Field("l_linenumber", "integer", nullable=False, is_primary_key=True),
        Field("flag", "string"),
        Field("quantity", "decimal(12,2)"),
    )
)


def one_dataset(
    spark: SparkSession, name: str, contract: Contract, **options
) -> tuple[Dataset, Layout]:
    return Dataset(name, f"raw_{name}", contract, **options), Layout.under(fresh_root(spark))


def land(
    df: DataFrame, dataset: Dataset, layout: Layout, wave: int, partition_by: str | None = None, **options
) -> None:
    """Put rows in the landing directory as CSV files, in a directory of their own."""
    writer = df.write.option("header", True).options(**options)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.csv(f"{layout.landing_of(dataset)}/wave{wave}")
