"""Scans of source tables kept outside the store: Parquet folders and JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.schemas import SOURCE_TABLES


def read_source(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One of the six source streams, from `<folder>/<table>` or `<table>.parquet`."""
    spec = SOURCE_TABLES[table]
    base = f"{folder.rstrip('/')}/{table}"
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    exists = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(spec.schema).parquet(base if exists else f"{base}.parquet")


def read_source_jdbc(
    spark: SparkSession, table: str, url: str, partitions: int = 64, **options: str
) -> DataFrame:
    """The same stream from a database, split into ranges of the id.

    Filters on the result, such as the mark, are pushed to the database.
    """
    spec = SOURCE_TABLES[table]
    options = {"preferTimestampNTZ": "true", **options}
    bounds = (
        spark.read.format("jdbc")
        .options(url=url, query=f"SELECT min({spec.key}) lo, max({spec.key}) hi FROM {table}", **options)
        .load()
        .first()
    )
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if bounds["lo"] is not None:
        reader = reader.options(
            partitionColumn=spec.key,
            lowerBound=str(bounds["lo"]),
            upperBound=str(bounds["hi"] + 1),
            numPartitions=str(partitions),
        )
    return reader.load().select(*(F.col(c.name).cast(c.type).alias(c.name) for c in spec.columns))
