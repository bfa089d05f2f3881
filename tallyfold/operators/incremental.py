"""High-water marks and the rows changed since them."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.calendar import stamp
from tallyfold.schemas import FIRST_MARK, MARKS, STREAMS


def seed_marks(spark) -> DataFrame:
    rows = [(s,) for s in STREAMS]
    return spark.createDataFrame(rows, "stream_name string").withColumn("last_loaded_ts", stamp(FIRST_MARK))


def get_mark(marks: DataFrame, stream: str) -> datetime | None:
    row = marks.where(F.col("stream_name") == stream).select("last_loaded_ts").first()
    return row[0] if row else None


def changed_since(df: DataFrame, column: str, mark: datetime | str) -> DataFrame:
    """Rows stamped at the mark or later.

    The mark is a literal, so the filter reaches the scan and Parquet
    statistics skip what is older.
    """
    return df.where(F.col(column) >= stamp(mark))


def incremental(
    df: DataFrame, marks: DataFrame, stream: str, column: str, overlap: timedelta = timedelta(0)
) -> DataFrame:
    """Rows changed since the stream's mark; none when the stream has no mark."""
    mark = get_mark(marks, stream)
    if mark is None:
        return df.where(F.lit(False))
    return changed_since(df, column, mark - overlap)


def advance_marks(marks: DataFrame, streams, batch_ts: datetime | str) -> DataFrame:
    """Move the marks of `streams` to `batch_ts`; streams without a mark stay without."""
    moved = F.col("stream_name").isin(*streams)
    return marks.select(
        "stream_name",
        F.when(moved, stamp(batch_ts)).otherwise(F.col("last_loaded_ts")).alias("last_loaded_ts"),
    ).select(*MARKS.names)
