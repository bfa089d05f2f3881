"""Helpers for functions that run on Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


PART = 1024  # rows


def by_batch(df: DataFrame, work: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """Applies `work` to every batch; it returns a column list for each column of `schema`."""
    return df.mapInArrow(_Mapper(work, df.sparkSession, schema), schema)


class _Mapper:
    def __init__(self, work, spark, schema):
        from pyspark.sql.pandas.types import to_arrow_schema
        from pyspark.sql.types import _parse_datatype_string

        self.work, self.schema = work, to_arrow_schema(_parse_datatype_string(schema))

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A part of a batch at a time, so that few of its texts are Python objects at once.
        for part in (batch.slice(s, PART) for batch in batches for s in range(0, batch.num_rows, PART)):
            columns = self.work(part)
            yield pa.RecordBatch.from_arrays(
                [_array(columns[f.name], f.type) for f in self.schema], schema=self.schema
            )


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


# Members of a bucket that meet in one step; larger buckets are cut into chunks that meet two by two.
CHUNK = 1024


def cells(entries: DataFrame, key: list[str], identity: str, chunk: int = CHUNK) -> DataFrame:
    """Lays out the buckets of `entries` so that all members of a bucket meet, at most two chunks in one place.

    Buckets with one member are left out. A bucket of more than `chunk` members is dealt into chunks by a hash of
    `identity`, and each pair of chunks is a cell (lo, hi) of its own: a hot bucket becomes many small steps on
    many tasks. Rows of a cell are neighbours in their partition, those of chunk lo first; `side` is 0 for lo, 1 for hi.
    """
    counts = entries.groupBy(*key).agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    mine = F.pmod(F.xxhash64(identity, F.lit(7)), F.col("chunks"))
    placed = (
        entries.join(counts, key)
        .withColumn("chunks", F.ceil(F.col("members") / F.lit(chunk)).cast("long"))
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        .withColumn("lo", F.least("mine", "other").cast("int"))
        .withColumn("hi", F.greatest("mine", "other").cast("int"))
        .withColumn("side", F.when(F.col("mine") == F.col("lo"), 0).otherwise(1).cast("byte"))
        .drop("members", "chunks", "mine", "other")
    )
    return placed.repartition(*key, "lo", "hi").sortWithinPartitions(*key, "lo", "hi", "side")


def runs(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """Tables of whole runs of equal `key`, each with the places where its runs start, and its end."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        now = now if held is None else pa.concat_tables([held, now]).combine_chunks()
        starts = run_starts(now, key)
        cut = int(starts[-1])
        if cut:
            yield now.slice(0, cut), starts
        held = now.slice(cut)
    if held is not None and held.num_rows:
        yield held, np.array([0, held.num_rows])


def run_starts(rows: pa.Table, key: list[str]) -> np.ndarray:
    new = np.zeros(rows.num_rows, bool)
    new[0] = True
    for name in key:
        values = rows[name].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def meet(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least member index of each row and column in the components of a link matrix; columns count after rows."""
    rows, columns = linked.shape
    left, right = np.arange(rows), rows + np.arange(columns)
    far = rows + columns
    while True:
        new_right = np.minimum(right, np.where(linked, left[:, None], far).min(0, initial=far))
        new_left = np.minimum(left, np.where(linked, new_right[None, :], far).min(1, initial=far))
        if (new_left == left).all() and (new_right == right).all():
            return left, right
        left, right = new_left, new_right
