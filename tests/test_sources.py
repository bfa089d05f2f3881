import datetime

import pytest

from tallyfold.schemas import SOURCE_TABLES
from tallyfold.session import shared_dir
from tallyfold.sources.tables import read_source, read_source_jdbc


class Reader:
    """Stands in for `spark.read`: records options, answers with prepared frames."""

    def __init__(self, frames):
        self.frames, self.calls, self.current = frames, [], {}

    def format(self, name):
        self.current = {"format": name}
        return self

    def options(self, **options):
        self.current.update(options)
        return self

    def load(self):
        self.calls.append(self.current)
        return self.frames["query" if "query" in self.current else "dbtable"]


class Session:
    def __init__(self, reader):
        self.read = reader


def test_jdbc_scan_is_split_by_id(spark):
    stamp = datetime.datetime(2024, 1, 1)
    rows = spark.createDataFrame(
        [(7, "n", "a", "t", None, stamp, stamp)],
        "client_id int, client_name string, client_address string, client_tax_id string, iban string, "
        "created_at timestamp, updated_at timestamp",
    )
    reader = Reader({"query": spark.createDataFrame([(1, 7)], "lo int, hi int"), "dbtable": rows})
    df = read_source_jdbc(Session(reader), "clients", "jdbc:x", partitions=8, user="u")
    assert df.schema == SOURCE_TABLES["clients"].schema
    _, scan = reader.calls
    assert scan == {
        "format": "jdbc",
        "url": "jdbc:x",
        "dbtable": "clients",
        "user": "u",
        "preferTimestampNTZ": "true",
        "partitionColumn": "client_id",
        "lowerBound": "1",
        "upperBound": "8",
        "numPartitions": "8",
    }


def test_jdbc_scan_of_an_empty_table(spark):
    empty = spark.createDataFrame([], SOURCE_TABLES["clients"].schema)
    reader = Reader({"query": spark.createDataFrame([(None, None)], "lo int, hi int"), "dbtable": empty})
    assert read_source_jdbc(Session(reader), "clients", "jdbc:x").count() == 0
    assert "partitionColumn" not in reader.calls[1]


@pytest.mark.parametrize("suffix", ["", ".parquet"])
def test_parquet_scan(spark, tmp_path, suffix):
    schema = SOURCE_TABLES["payments"].schema
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"payments{suffix}"))
    assert read_source(spark, str(tmp_path), "payments").schema == schema


def test_shared_folder_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_staged_tables_of_a_job_are_removed(spark):
    import os

    from tallyfold.session import scratch, side_by_side, stage

    def folder(df):
        return os.path.dirname(df.inputFiles()[0].removeprefix("file://"))

    with scratch(spark):
        first, second = side_by_side(lambda: stage(spark.range(3)), lambda: stage(spark.range(4)))
        paths = [folder(first), folder(second)]
        assert first.count() + second.count() == 7 and all(os.path.exists(p) for p in paths)
        assert os.path.dirname(paths[0]) == os.path.dirname(paths[1])
    assert not any(os.path.exists(p) for p in paths)
    kept = stage(spark.range(3))
    assert kept.count() == 3


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, _name, default=None):
            return default

    class Cluster:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "yarn", "applicationId": "a"})

    with pytest.raises(RuntimeError):
        shared_dir(Cluster())
