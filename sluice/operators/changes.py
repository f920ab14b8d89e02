"""Change rows: between two states of a table, and the ones a load takes up."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.columns import any_null, free_name, none_null, quoted, quoted_all

CHANGE_TYPE = "_change_type"
COMMIT_VERSION = "_commit_version"
COMMIT_TIMESTAMP = "_commit_timestamp"
COPIES = "_copies"
FEED_COLUMNS = (CHANGE_TYPE, COMMIT_VERSION, COMMIT_TIMESTAMP, COPIES)

# The change types of a feed.
INSERT = "insert"
DELETE = "delete"
UPDATE_BEFORE = "update_preimage"
UPDATE_AFTER = "update_postimage"

TAKEN_UP = (INSERT, UPDATE_AFTER)
# A filter that lets no update through, for those who rely on it.
TAKEN_UP_COMPAT = ("insert", "update")


def table_changes(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What changed from ``before`` to ``after``, as feed rows.

    A row only in ``after`` is an insert and a row only in ``before`` a delete, unless its key
    has both: then they are the two images of an update. Equal rows cancel out in one
    aggregate over both tables; copies of a row are counted in ``_copies`` instead of being
    paired with one another. A key with a NULL matches nothing, so it is never an update.
    """
    names = before.columns
    n, updated = free_name("_n", names), free_name("_updated", names)
    side, side_of = free_name("_spread", names), free_name("_spread_of", names)
    key_of = [free_name(f"_key{i}", names) for i in range(len(keys))]
    both = before.withColumn(n, F.lit(-1)).unionByName(after.withColumn(n, F.lit(1)))
    net = both.groupBy(*quoted_all(names)).agg(F.sum(n).alias(n)).filter(F.col(n) != 0)
    # The rows are distinct now. Those with a NULL key are spread by their other values.
    spread = F.when(any_null(keys), F.xxhash64(*quoted_all(names))).otherwise(F.lit(0).cast("long"))
    net = net.withColumn(side, spread)

    sides = net.groupBy(*[quoted(key).alias(name) for key, name in zip(keys, key_of)], side).agg(
        ((F.min(n) < 0) & (F.max(n) > 0)).alias(updated)
    )
    sides = sides.withColumnRenamed(side, side_of)
    # Null-safe, for both sides to be the same plan: plain equality would filter one of them
    # below the aggregate, and the shuffle of the two tables could not be shared. It also makes
    # Spark shuffle the few updated keys once more, without which AQE could not split a hot key.
    same_key = reduce(
        Column.__and__,
        [quoted(key).eqNullSafe(quoted(name)) for key, name in zip(keys, key_of)],
        quoted(side) == quoted(side_of),
    )
    known = net.join(sides.filter(quoted(updated)), same_key, "left")
    is_updated = quoted(updated).isNotNull() & none_null(keys)
    change = (
        F.when(is_updated & (F.col(n) > 0), UPDATE_AFTER)
        .when(is_updated, UPDATE_BEFORE)
        .when(F.col(n) > 0, INSERT)
        .otherwise(DELETE)
    )
    return known.select(*quoted_all(names), change.alias(CHANGE_TYPE), F.abs(n).alias(COPIES))


def keep_changes(feed: DataFrame, types: Sequence[str] = TAKEN_UP) -> DataFrame:
    """The feed rows a load takes up, by change type; deletes are passed over."""
    return feed.filter(F.col(CHANGE_TYPE).isin(*types))


def drop_feed_columns(feed: DataFrame) -> DataFrame:
    """The table's own columns. Only the feed's columns go; others may start with ``_``."""
    return feed.drop(*FEED_COLUMNS)
