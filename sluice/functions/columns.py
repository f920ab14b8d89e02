"""Small column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """A column by its literal name: dots and blanks are part of the name."""
    return F.col("`" + name.replace("`", "``") + "`")


def quoted_all(names: Iterable[str]) -> list[Column]:
    return [quoted(name) for name in names]


def any_null(names: Iterable[str]) -> Column:
    return reduce(Column.__or__, [quoted(name).isNull() for name in names])


def none_null(names: Iterable[str]) -> Column:
    return reduce(Column.__and__, [quoted(name).isNotNull() for name in names])


def free_name(base: str, *taken: Iterable[str]) -> str:
    """A name for a temporary column that none of the given ones has."""
    used = {name.lower() for names in taken for name in names}
    while base.lower() in used:
        base += "_"
    return base
