"""Raw text rows to contract-typed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.columns import quoted, quoted_all
from sluice.functions.parsing import typed
from sluice.plans.contract import Contract


def source_names(columns: Sequence[str], contract: Contract, ignore_case: bool = False) -> dict[str, str]:
    """Contract column -> column of the input that feeds it; absent columns are left out."""
    if not ignore_case:
        present = set(columns)
        return {name: name for name in contract.names if name in present}
    folded = {column.lower(): column for column in reversed(columns)}
    folded_names = {name: folded.get(name.lower()) for name in contract.names}
    return {name: column for name, column in folded_names.items() if column is not None}


def conform(
    df: DataFrame,
    contract: Contract,
    strict: bool = False,
    ignore_case: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One narrow projection to the contract's columns, in contract order.

    Contract columns the input lacks become typed NULLs, input columns outside the contract
    drop out. ``carry`` names input columns that pass through unchanged, after the others.
    """
    source = source_names(df.columns, contract, ignore_case)
    columns = []
    for field in contract.fields:
        to = contract.type_of(field)
        if field.name in source:
            value = typed(quoted(source[field.name]), to, field.date_formats, strict)
        else:
            value = F.lit(None).cast(to)
        columns.append(value.alias(field.name))
    return df.select(*columns, *quoted_all(carry))
