"""Every registered query against its SQL, on whole tables."""

import pytest

from __spark_entry__ import entry
from railgauge.registry.oracle import SQL
from railgauge.registry.queries import QUERIES

from compare import connect, spark_rows, sql_rows


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, duck, name):
    columns, rows = spark_rows(QUERIES[name](spark, sf_dir))
    expected_columns, expected_rows = sql_rows(duck, SQL[name])
    assert columns == expected_columns
    assert rows == expected_rows


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1
