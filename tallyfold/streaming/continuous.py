"""The cycle run continuously over folders that receive change files."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyfold.plans.cycle import Load, run_cycle, utc_now
from tallyfold.schemas import SOURCE_TABLES, STREAMS
from tallyfold.session import writing
from tallyfold.sources.store import TableStore

STREAM = "stream"


def change_stream(
    spark: SparkSession,
    folders: dict[str, str],
    files_per_trigger: int | None = None,
    archive: str | None = None,
    oldest: str | None = None,
) -> DataFrame:
    """All source streams as one: the stream's name and, in the column of that
    name, its row. Folders receive Parquet files of new and changed rows.

    With `archive`, a folder outside of the landing folders, a file moves there
    once the batch after its own has begun, so that a landing folder lists new
    files only, however long the stream runs. `oldest` (`7d`) is how far behind
    the newest file one may be and still be taken; what the checkpoint has to
    remember is bounded by it.
    """
    frames = {}
    for name in STREAMS:
        schema = SOURCE_TABLES[name].schema
        reader = spark.readStream.schema(schema)
        if files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", files_per_trigger)
        if archive:
            reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", f"{archive}/{name}")
        if oldest:
            reader = reader.option("maxFileAge", oldest)
        frames[name] = reader.parquet(folders[name])
    return one_stream(frames)


def one_stream(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows of several source tables as one frame; `rows_of` takes them apart."""
    parts = []
    for name, rows in frames.items():
        columns = [
            F.struct(*rows.columns).alias(o) if o == name else F.lit(None).cast(SOURCE_TABLES[o].schema).alias(o)
            for o in STREAMS
        ]
        parts.append(rows.select(F.lit(name).alias(STREAM), *columns))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def rows_of(batch: DataFrame, name: str) -> DataFrame:
    """Rows of one stream in a batch. The name is a constant in each part of
    the union, so the planner drops the files of all other streams."""
    return batch.where(F.col(STREAM) == name).select(f"{name}.*")


def take_batch(
    star: TableStore,
    batch: DataFrame,
    stream: str,
    number: int,
    batch_ts: datetime,
    on_unresolved: Callable[[str, DataFrame], None] | None = None,
    retries: int = 1,
    retry_delay: float = 120.0,
) -> dict[str, int]:
    """One batch of `change_stream` into the star; returns rows per table.

    The number of the batch is published with its dimensions and again with its
    facts: a batch that is given again, after a failure anywhere, loads only the
    group that it had not published. All rows count whatever their stamp, those
    without a stamp included.
    """
    load = Load(
        star,
        lambda name: rows_of(batch, name),
        newest_only=True,
        every_row=True,
        on_unresolved=on_unresolved,
        batch=(stream, number),
    )
    with writing(batch.sparkSession):
        return run_cycle(load, batch_ts, retries=retries, retry_delay=retry_delay)


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Identity of the stream that a checkpoint belongs to. A new checkpoint counts batches from 0 under a new one."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def run_stream(
    spark: SparkSession,
    star: TableStore,
    folders: dict[str, str],
    checkpoint: str,
    interval: str | None = "5 minutes",
    on_unresolved: Callable[[str, DataFrame], None] | None = None,
    retries: int = 1,
    retry_delay: float = 120.0,
    files_per_trigger: int | None = None,
    clock: Callable = utc_now,
    archive: str | None = None,
    oldest: str | None = None,
) -> StreamingQuery:
    """Start the continuous cycle; `interval=None` takes what is there and stops.

    A missed interval is not made up for: the next batch holds all files that
    arrived. The checkpoint gives each file once, so every row is taken
    whatever its stamp; an older version of a row never replaces a newer one. A
    batch that is repeated after a failure loads nothing twice, in either mode of
    the star (`take_batch`). `on_unresolved` receives the rows that found no
    dimension row. `archive` and `oldest`: see `change_stream`.
    """

    def cycle(batch: DataFrame, number: int) -> None:
        take_batch(star, batch, _stream_id(spark, checkpoint), number, clock(), on_unresolved, retries, retry_delay)

    writer = (
        change_stream(spark, folders, files_per_trigger, archive, oldest)
        .writeStream.foreachBatch(cycle)
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()
