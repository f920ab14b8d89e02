"""Turning raw text into a typed value: every accepted reading, first hit wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def readings(raw: Column, to: T.DataType, formats: Sequence[str] = (), strict: bool = False) -> list[Column]:
    """The plain cast first, then one reading per declared format, in that order.

    Formats count for dates and timestamps only. The tolerant readings give NULL for text
    they cannot read, under ANSI mode and without. ``strict`` uses the raising parsers, so
    under ANSI mode the first format that misses fails the query.
    """
    tried = [raw.try_cast(to)]
    if isinstance(to, T.DateType):
        parse = F.to_date if strict else F.try_to_date
        tried += [parse(raw, fmt) for fmt in formats]
    elif isinstance(to, T.TimestampType):
        tried += [
            F.to_timestamp(raw, fmt) if strict else F.try_to_timestamp(raw, F.lit(fmt)) for fmt in formats
        ]
    return tried


def typed(raw: Column, to: T.DataType, formats: Sequence[str] = (), strict: bool = False) -> Column:
    """The first reading that is not NULL, as the target type."""
    return F.coalesce(*readings(raw, to, formats, strict)).cast(to)
