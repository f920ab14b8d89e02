"""Operators on key groups. Each reduces map-side first, so a hot key costs no more than others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.columns import any_null, free_name, none_null, quoted, quoted_all


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    row_id: Sequence[str] = (),
    copies: str | None = None,
) -> DataFrame:
    """One row per key: the one with the greatest ``order`` columns, ties by the other columns.

    An aggregate rather than a window: copies of a key meet in the map-side combine, so no
    task ever holds all rows of one key. With ``row_id`` (columns that identify a row), rows
    with a NULL in the key are all kept, since such a key equals no other. ``copies`` names a
    further column for the number of rows of the key.
    """
    rest = [name for name in df.columns if name not in keys and name not in order]
    group = quoted_all(keys)
    loose, best = free_name("_loose", df.columns), free_name("_winner", df.columns)
    if row_id:
        # NULL for whole keys, so these still hash by the key alone.
        group.append(F.when(any_null(keys), F.struct(*quoted_all(row_id))).alias(loose))
    wanted = [F.max(F.struct(*quoted_all([*order, *rest]))).alias(best)]
    values = [quoted(name) if name in keys else F.col(best).getField(name).alias(name) for name in df.columns]
    if copies:
        wanted.append(F.count(F.lit(1)).alias(copies))
        values.append(quoted(copies))
    return df.groupBy(*group).agg(*wanted).select(*values)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the number of rows. NULL keys equal nothing."""
    return (
        df.filter(none_null(keys))
        .groupBy(*quoted_all(keys))
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
    )
