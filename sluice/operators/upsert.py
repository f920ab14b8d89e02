"""Keyed merge of new rows into a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.columns import any_null, free_name, none_null, quoted, quoted_all


def unmatched(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose whole key is not in the source; expects no NULL in target keys.

    An anti join: Spark may broadcast the source keys when they are small, and AQE can split
    a hot target key, neither of which a full outer join allows.
    """
    wanted = source.filter(none_null(keys)).select(*quoted_all(keys))
    kept = target.join(wanted, on=list(keys), how="left_anti")
    return kept.select(*quoted_all(target.columns))


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Rows of ``source`` replace rows of ``target`` with the same key; the others are added.

    Keys match by plain equality, so a NULL in a key matches nothing: such rows stay, and are
    added each time. The source should hold each key once. ``keep`` names columns whose
    present target value survives a match.
    """
    # NULL keys would all hash to one join partition; they cannot match, so they go around it.
    loose = target.filter(any_null(keys))
    whole = target.filter(none_null(keys))
    kept = unmatched(whole, source, keys).unionByName(loose)
    incoming = keep_values(whole, source, keys, keep) if keep else source
    return kept.unionByName(incoming.select(*quoted_all(target.columns)))


def keep_values(target: DataFrame, source: DataFrame, keys: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Source rows, with the ``keep`` columns taken from the matching target row where there is one."""
    loose = source.filter(any_null(keys))
    whole = source.filter(none_null(keys))
    # Only the target rows in question go on, and one of them per key.
    matched = target.join(whole.select(*quoted_all(keys)), on=list(keys), how="left_semi")
    there = free_name("_held", source.columns)
    held = matched.groupBy(*quoted_all(keys)).agg(F.max(F.struct(*quoted_all(keep))).alias(there))
    joined = whole.join(held, on=list(keys), how="left")
    chosen = [
        F.when(F.col(there).isNotNull(), F.col(there).getField(name)).otherwise(quoted(name)).alias(name)
        if name in keep
        else quoted(name)
        for name in source.columns
    ]
    return joined.select(*chosen).unionByName(loose)
