"""Every registered query against DuckDB."""

import oracle
import pytest

import __spark_entry__ as entry_point
from tallyfold.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    df = QUERIES[name](spark, FOLDER)
    assert oracle.compare(df, connection, SQL[name]) == []


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
