"""Contract type names and the Spark types they stand for."""

from __future__ import annotations

import re

from pyspark.sql import types as T

# The type names a contract may use.
SCALAR_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "date": T.DateType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}

# What compat mode makes of a decimal it cannot read, and of any other name.
COMPAT_DECIMAL = T.DecimalType(10, 2)
COMPAT_OTHER = T.StringType()

_COMPACT_DECIMAL = re.compile(r"decimal\((\d+),(\d+)\)")
_SPACED_DECIMAL = re.compile(r"decimal\s*\(\s*(\d+)\s*,\s*(\d+)\s*\)")


def resolve_type(name: str, compat: bool = False) -> T.DataType:
    """The Spark type of a contract type name; case does not matter.

    By default an unknown name is an error and ``decimal(5, 2)`` may hold blanks.
    ``compat`` never fails: a decimal that is not exactly ``decimal(p,s)`` becomes
    ``decimal(10,2)`` and any other unknown name becomes ``string``.
    """
    text = name.strip().lower() if not compat else name.lower()
    if text in SCALAR_TYPES:
        return SCALAR_TYPES[text]
    if compat:
        # A prefix match: text after the closing bracket does not matter.
        found = _COMPACT_DECIMAL.match(text)
        if found:
            return T.DecimalType(int(found[1]), int(found[2]))
        return COMPAT_DECIMAL if text.startswith("decimal") else COMPAT_OTHER
    found = _SPACED_DECIMAL.fullmatch(text)
    if not found:
        raise ValueError(f"unknown contract type {name!r}")
    precision, scale = int(found[1]), int(found[2])
    if not (1 <= precision <= 38 and scale <= precision):
        raise ValueError(f"decimal out of range: {name!r}")
    return T.DecimalType(precision, scale)
