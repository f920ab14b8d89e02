"""Reports on a load, as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.columns import quoted
from sluice.functions.parsing import typed
from sluice.operators.conform import source_names
from sluice.plans.contract import Contract

NOT_FOUND = "NOT_FOUND"


def schema_summary(raw: DataFrame, contract: Contract) -> DataFrame:
    """Per contract column: its type in the raw table, or NOT_FOUND, and its declared type."""
    present = {field.name: str(field.dataType) for field in raw.schema.fields}
    rows = [
        (position, field.name, present.get(field.name, NOT_FOUND), field.type)
        for position, field in enumerate(contract.fields, start=1)
    ]
    return raw.sparkSession.createDataFrame(
        rows, "position int, column_name string, raw_type string, typed_as string"
    )


def contract_report(raw: DataFrame, contract: Contract, ignore_case: bool = False) -> DataFrame:
    """Per contract column, in one pass over the raw rows: rows, unreadable values, violations.

    ``cast_failures`` counts raw values that no reading could parse, ``null_violations`` NULLs
    in columns declared not nullable (an absent column counts every row), ``nulls`` all NULLs.
    """
    source = source_names(raw.columns, contract, ignore_case)
    entries = []
    for field in contract.fields:
        to = contract.type_of(field)
        text = quoted(source[field.name]) if field.name in source else F.lit(None).cast("string")
        value = typed(text, to, field.date_formats)
        nulls = F.count_if(value.isNull())
        entries.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.count(F.lit(1)).alias("row_count"),
                nulls.alias("nulls"),
                F.count_if(text.isNotNull() & value.isNull()).alias("cast_failures"),
                (F.lit(0).cast("long") if field.nullable else nulls).alias("null_violations"),
            )
        )
    return raw.agg(F.array(*entries).alias("_columns")).select(F.inline("_columns"))


def load_summary(table: DataFrame, dataset: str) -> DataFrame:
    """Row count of a loaded table."""
    return table.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(dataset).alias("dataset"), "row_count")


def preview(table: DataFrame, rows: int = 5) -> DataFrame:
    """A few rows to look at, in no particular order."""
    return table.limit(rows)
