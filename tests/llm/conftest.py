import duckdb
import pytest

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def sql():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection
