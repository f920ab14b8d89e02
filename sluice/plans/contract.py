"""The declared shape of a typed table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import types as T

from sluice.functions.types import resolve_type

# Names that the raw and the typed table keep for themselves. A test holds them
# against the tables' own lists.
RESERVED_NAMES = frozenset(
    "_change_type _commit_version _commit_timestamp _copies _source_file _file_time _block_start _row_id "
    "_unfit_line _metadata _load _bucket".split()
)


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    nullable: bool = True
    description: str = ""
    is_primary_key: bool = False
    date_formats: tuple[str, ...] = ()


@dataclass(frozen=True)
class Contract:
    """Ordered fields; the fields marked as primary key identify a row."""

    fields: tuple[Field, ...]
    description: str = ""
    compat_types: bool = False

    @classmethod
    def from_dict(cls, definition: Mapping, compat_types: bool = False) -> Contract:
        """Build from the JSON form: ``{"fields": [{"name", "type", ...}], "description"}``."""
        fields = tuple(
            Field(
                name=entry["name"],
                type=entry["type"],
                nullable=entry.get("nullable", True),
                description=entry.get("description", ""),
                is_primary_key=bool(entry.get("is_primary_key")),
                date_formats=tuple(entry.get("date_formats") or ()),
            )
            for entry in definition.get("fields") or ()
        )
        return cls(fields, definition.get("description", ""), compat_types)

    @property
    def names(self) -> list[str]:
        return [field.name for field in self.fields]

    @property
    def keys(self) -> list[str]:
        return [field.name for field in self.fields if field.is_primary_key]

    def type_of(self, field: Field) -> T.DataType:
        return resolve_type(field.type, self.compat_types)

    def to_struct(self) -> T.StructType:
        """Spark schema in contract order, the other declarations as field metadata.

        Every column is nullable: ``nullable: false`` is reported on, not enforced.
        """
        return T.StructType(
            [
                T.StructField(
                    field.name,
                    self.type_of(field),
                    True,
                    {
                        "comment": field.description,
                        "declared_type": field.type,
                        "declared_nullable": field.nullable,
                        "primary_key": field.is_primary_key,
                        "date_formats": list(field.date_formats),
                    },
                )
                for field in self.fields
            ]
        )

    def problems(self) -> list[str]:
        """Everything that makes this contract unusable, as text."""
        found = []
        if not self.fields:
            found.append("no fields")
        seen: set[str] = set()
        for field in self.fields:
            if field.name.lower() in seen:
                found.append(f"column {field.name!r} is declared twice")
            seen.add(field.name.lower())
            if field.name.lower() in RESERVED_NAMES:
                found.append(f"column {field.name!r} has a reserved name")
            try:
                self.type_of(field)
            except ValueError as error:
                found.append(f"column {field.name!r}: {error}")
        if self.fields and not self.keys:
            found.append("no primary key")
        return found


def check_evolution(
    stored: T.StructType, stored_keys: list[str], wanted: Contract, ever: Mapping[str, str] | None = None
) -> None:
    """New and dropped columns are fine; a changed type or key needs a fresh table.

    ``ever`` holds the types of all columns there were, dropped ones too, by name in lower case:
    a dropped column may come back with the same type only, and is NULL until it is loaded anew.
    """
    before = {field.name.lower(): field.dataType.simpleString() for field in stored}
    before = {**(ever or {}), **before}
    for field in wanted.to_struct():
        new = field.dataType.simpleString()
        old = before.get(field.name.lower(), new)
        if old != new:
            raise ValueError(f"column {field.name!r} changed from {old} to {new}")
    if sorted(stored_keys) != sorted(wanted.keys):
        raise ValueError(f"primary key changed from {stored_keys} to {wanted.keys}")
