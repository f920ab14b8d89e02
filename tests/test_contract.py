from __future__ import annotations

import json

import pytest
from pyspark.sql import types as T

from sluice import Contract, Dataset, Field, read_registry
from sluice.functions.types import resolve_type
from sluice.plans.contract import check_evolution


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("string", T.StringType()),
        ("Date", T.DateType()),
        ("INTEGER", T.IntegerType()),
        ("long", T.LongType()),
        ("float", T.FloatType()),
        ("double", T.DoubleType()),
        ("boolean", T.BooleanType()),
        ("timestamp", T.TimestampType()),
        ("decimal(5,2)", T.DecimalType(5, 2)),
        ("Decimal(38,0)", T.DecimalType(38, 0)),
    ],
)
def test_known_types_in_both_modes(name, expected):
    assert resolve_type(name) == expected
    assert resolve_type(name, compat=True) == expected


def test_blanks_in_a_decimal_are_read_by_default_only():
    assert resolve_type("decimal(5, 2)") == T.DecimalType(5, 2)
    assert resolve_type("decimal(5, 2)", compat=True) == T.DecimalType(10, 2)


@pytest.mark.parametrize("name", ["int", "bigint", "timestamp_ntz", "array<string>", "decimal", "decimal(50,2)"])
def test_unknown_types_are_errors_by_default(name):
    with pytest.raises(ValueError, match="decimal|unknown"):
        resolve_type(name)


@pytest.mark.parametrize("name", ["int", "bigint", "timestamp_ntz", "array<string>", " date"])
def test_unknown_types_are_text_in_compat_mode(name):
    assert resolve_type(name, compat=True) == T.StringType()


def test_odd_decimal_in_compat_mode():
    assert resolve_type("decimal", compat=True) == T.DecimalType(10, 2)


def test_contract_from_json():
    text = """{"fields": [
        {"name": "k", "type": "string", "nullable": false, "description": "the key", "is_primary_key": true},
        {"name": "d", "type": "date", "date_formats": ["dd/MM/yyyy", "yyyy.MM.dd"]}], "description": "a table"}"""
    contract = Contract.from_dict(json.loads(text))
    assert contract.names == ["k", "d"]
    assert contract.keys == ["k"]
    assert contract.description == "a table"
    struct = contract.to_struct()
    assert struct["d"].dataType == T.DateType()
    assert struct["d"].metadata["date_formats"] == ["dd/MM/yyyy", "yyyy.MM.dd"]
    assert struct["k"].metadata == {
        "comment": "the key",
        "declared_type": "string",
        "declared_nullable": False,
        "primary_key": True,
        "date_formats": [],
    }
    assert contract.problems() == []


def test_problems_are_all_listed():
    contract = Contract((Field("a", "int"), Field("A", "string")))
    assert contract.problems() == [
        "column 'a': unknown contract type 'int'",
        "column 'A' is declared twice",
        "no primary key",
    ]
    assert Contract(()).problems() == ["no fields"]


def test_reserved_names_are_problems():
    from sluice.plans.contract import RESERVED_NAMES
    from sluice.sources import bronze, silver

    assert RESERVED_NAMES == bronze.RESERVED | silver.RESERVED
    for name in ("_bucket", "_Load", "_change_type", "_row_id"):
        contract = Contract((Field("k", "string", is_primary_key=True), Field(name, "string")))
        assert contract.problems() == [f"column {name!r} has a reserved name"]


def test_a_dropped_column_comes_back_with_its_type_only():
    stored = T.StructType([T.StructField("k", T.StringType())])
    key = Field("k", "string", is_primary_key=True)
    check_evolution(stored, ["k"], Contract((key, Field("x", "long"))), {"x": "bigint"})
    with pytest.raises(ValueError, match="'X' changed from bigint to string"):
        check_evolution(stored, ["k"], Contract((key, Field("X", "string"))), {"x": "bigint"})


def test_evolution():
    stored = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.IntegerType())])
    key = Field("k", "string", is_primary_key=True)
    check_evolution(stored, ["k"], Contract((key, Field("n", "integer"), Field("new", "date"))))
    check_evolution(stored, ["k"], Contract((key,)))
    with pytest.raises(ValueError, match="'n' changed from int to bigint"):
        check_evolution(stored, ["k"], Contract((key, Field("n", "long"))))
    with pytest.raises(ValueError, match="primary key changed"):
        check_evolution(stored, ["k"], Contract((key, Field("n", "integer", is_primary_key=True))))


def test_registry_reports_malformed_entries():
    entries = [
        {"subdir": "a", "target_table": "raw_a"},
        {"subdir": "b"},
        {"target_table": "raw_c"},
        {"subdir": "d", "target_table": "raw_d"},
    ]
    definitions = {"a": {"fields": [{"name": "k", "type": "string", "is_primary_key": True}]}}
    good, bad = read_registry(entries, definitions, on_duplicate="error")
    assert [(d.name, d.raw_name, d.typed_name, d.on_duplicate) for d in good] == [
        ("a", "raw_a", "a_silver", "error"),
        ("d", "raw_d", "d_silver", "error"),
    ]
    broken = {"a": {"fields": [{"name": "k"}]}, "d": {"fields": "none"}}
    assert read_registry(entries[:1] + entries[3:], broken) == ([], [entries[0], entries[3]])
    assert good[0].contract.keys == ["k"]
    assert good[1].contract is None
    assert bad == entries[1:3]


def test_dataset_rejects_an_unknown_duplicate_rule():
    with pytest.raises(ValueError, match="on_duplicate"):
        Dataset("a", "raw_a", on_duplicate="some")
