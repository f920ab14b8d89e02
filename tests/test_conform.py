from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice import Contract, Field, conform, contract_report, load_summary, preview, schema_summary
from tests.helpers import MEMBERS, rows

D = dt.date
TWO_FORMATS = ("dd/MM/yyyy", "yyyy.MM.dd")

CASES = [
    ("date", TWO_FORMATS, "2024-01-15", D(2024, 1, 15)),
    ("date", TWO_FORMATS, "2024", D(2024, 1, 1)),
    ("date", TWO_FORMATS, "15/05/2000", D(2000, 5, 15)),
    ("date", TWO_FORMATS, "2000.05.15", D(2000, 5, 15)),
    ("date", TWO_FORMATS, "31/02/2000", None),
    ("date", TWO_FORMATS, "5/5/2000", None),
    ("date", TWO_FORMATS, "garbage", None),
    ("date", TWO_FORMATS, "", None),
    ("date", TWO_FORMATS, None, None),
    ("date", (), "15/05/2000", None),
    ("decimal(5,2)", (), "285", Decimal("285.00")),
    ("decimal(5,2)", (), "1000", None),
    ("decimal(5,2)", (), "95.005", Decimal("95.01")),
    ("decimal(5,2)", (), " 95 ", Decimal("95.00")),
    ("decimal(5,2)", (), "1e2", Decimal("100.00")),
    ("decimal(5,2)", (), "x", None),
    ("integer", (), "3.7", None),
    ("integer", (), "37", 37),
    ("integer", (), "3000000000", None),
    ("long", (), "3000000000", 3000000000),
    ("float", (), "1.5", 1.5),
    ("double", (), "1e3", 1000.0),
    ("boolean", (), "yes", True),
    ("boolean", (), "1", True),
    ("boolean", (), "maybe", None),
    ("timestamp", ("dd/MM/yyyy HH:mm",), "2024-01-15 10:30:00.25", dt.datetime(2024, 1, 15, 10, 30, 0, 250000)),
    ("timestamp", ("dd/MM/yyyy HH:mm",), "15/01/2024 10:30", dt.datetime(2024, 1, 15, 10, 30)),
    ("timestamp", ("dd/MM/yyyy HH:mm",), "15/13/2024 10:30", None),
    ("string", ("dd/MM/yyyy",), "15/05/2000", "15/05/2000"),
    ("string", (), " a ", " a "),
]


def one_column(type_name, formats=()):
    return Contract((Field("v", type_name, date_formats=tuple(formats)),))


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_edge_values_do_not_depend_on_ansi_mode(spark, settings, ansi):
    settings("spark.sql.ansi.enabled", ansi)
    raw = spark.createDataFrame([(text,) for _, _, text, _ in CASES], "v string").withColumn("raw", F.col("v"))
    by_kind = {}
    for type_name, formats, text, expected in CASES:
        by_kind.setdefault((type_name, formats), []).append((text, expected))
    for (type_name, formats), cases in by_kind.items():
        out = conform(raw, one_column(type_name, formats), carry=["raw"])
        got = {row.raw: row.v for row in out.collect()}
        for text, expected in cases:
            value = got[text]
            if isinstance(expected, dt.datetime):
                assert value.replace(tzinfo=None) == expected, (type_name, text)
            else:
                assert value == expected, (type_name, text)


def test_strict_mode_raises_on_the_first_format_that_misses(spark, settings):
    settings("spark.sql.ansi.enabled", "true")
    contract = one_column("date", TWO_FORMATS)
    good = spark.createDataFrame([("2024-01-15",), ("15/05/2000",)], "v string")
    assert conform(good, contract, strict=True).count() == 2
    assert rows(conform(good, contract, strict=True)) == rows(conform(good, contract))
    for text in ("garbage", "2000.05.15"):
        bad = spark.createDataFrame([(text,)], "v string")
        with pytest.raises(PySparkException, match="CANNOT_PARSE_TIMESTAMP"):
            conform(bad, contract, strict=True).collect()


def test_strict_mode_without_ansi_gives_null(spark, settings):
    settings("spark.sql.ansi.enabled", "false")
    bad = spark.createDataFrame([("garbage",), ("2000.05.15",)], "v string")
    got = [row.v for row in conform(bad, one_column("date", TWO_FORMATS), strict=True).collect()]
    assert got == [None, D(2000, 5, 15)]


def test_columns_follow_the_contract(spark):
    raw = spark.createDataFrame([("7", "x", "A1")], "points string, junk string, member_id string")
    out = conform(raw, MEMBERS)
    assert out.columns == MEMBERS.names
    assert [field.dataType for field in out.schema] == [field.dataType for field in MEMBERS.to_struct()]
    assert out.collect()[0] == ("A1", None, None, Decimal("7.00"), None)


def test_names_match_by_case_unless_told_otherwise(spark):
    contract = Contract((Field("email", "string"),))
    raw = spark.createDataFrame([("a@b",)], "Email string")
    assert conform(raw, contract).first().email is None
    assert conform(raw, contract, ignore_case=True).first().email == "a@b"


def test_odd_column_names(spark):
    contract = Contract((Field("a.b", "integer", is_primary_key=True), Field("c d", "date"), Field("e`f", "string")))
    schema = T.StructType([T.StructField(name, T.StringType()) for name in ["a.b", "c d", "e`f", "_x"]])
    raw = spark.createDataFrame([("1", "2024-01-02", "t", "u")], schema)
    assert tuple(conform(raw, contract, carry=["_x"]).first()) == (1, D(2024, 1, 2), "t", "u")


def test_a_typed_input_that_cannot_become_a_date_is_refused(spark):
    raw = spark.createDataFrame([(1,)], "v int")
    with pytest.raises(PySparkException, match="DATATYPE_MISMATCH"):
        conform(raw, one_column("date")).collect()


def test_schema_summary(spark):
    raw = spark.createDataFrame([("A1", 3)], "member_id string, points int")
    assert [tuple(row) for row in schema_summary(raw, MEMBERS).orderBy("position").collect()] == [
        (1, "member_id", "StringType()", "string"),
        (2, "given_name", "NOT_FOUND", "string"),
        (3, "born_on", "NOT_FOUND", "date"),
        (4, "points", "IntegerType()", "decimal(5,2)"),
        (5, "joined_on", "NOT_FOUND", "date"),
    ]


def test_contract_report(spark):
    raw = spark.createDataFrame(
        [("A", "n", "01/02/2000", "5"), ("B", None, "bad", "9999"), (None, "m", None, None)],
        "member_id string, given_name string, born_on string, points string",
    )
    got = {row.column_name: tuple(row)[1:] for row in contract_report(raw, MEMBERS).collect()}
    assert got == {
        "member_id": (3, 1, 0, 1),
        "given_name": (3, 1, 0, 1),
        "born_on": (3, 2, 1, 2),
        "points": (3, 2, 1, 0),
        "joined_on": (3, 3, 0, 3),
    }


def test_summary_and_preview(spark):
    table = spark.range(12)
    assert [tuple(row) for row in load_summary(table, "t").collect()] == [("t", 12)]
    assert preview(table).count() == 5
