"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from checks.compare import spark_rows, sql_rows
from checks.queries import QUERIES
from checks.sql import SQL

SMALL = "/root/testdata/sf0.001"


def test_each_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(driver.queries()) and set(SQL) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    names, got = spark_rows(spark, name, SMALL)
    expected_names, expected = sql_rows(name, SMALL)
    assert names == expected_names
    assert got == expected


def test_entry(spark):
    assert driver.entry(spark).count() > 0
