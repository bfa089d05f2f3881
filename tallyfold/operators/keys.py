"""Numbering of rows without gathering them in one place.

Rows are counted per group first, the counts become offsets, and rows are then
numbered inside each group. Offsets are made on two levels: sums within spans of
groups by a window in Spark, and only the totals of the spans, a bounded number
of rows whatever the input, on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.session import stage

GROUP = "_group"
OFFSET = "_offset"
POSITION = "_position"

SMALL_BLOCK = 1 << 16
LARGE_BLOCK = 1 << 20
MOST_BLOCKS = 1 << 18
SPAN = 1 << 9  # groups whose counts are added up in one task; at most MOST_BLOCKS / SPAN + 1 totals reach the driver


def block_width(spark, low: int, high: int) -> int:
    """Ids per group for ids between `low` and `high`.

    Small enough to give every core work, at most about a million ids as long
    as that keeps the number of groups (and of counts on the driver) bounded.
    """
    span = high - low + 1
    even = -(-span // (4 * spark.sparkContext.defaultParallelism))
    return max(min(max(even, SMALL_BLOCK), LARGE_BLOCK), -(-span // MOST_BLOCKS))


def offsets_frame(spark, counts: dict[int, int], start: int) -> DataFrame:
    """First number minus one of each group, for groups numbered in order."""
    groups = sorted(counts)
    before = accumulate((counts[g] for g in groups), initial=start)
    frame = spark.createDataFrame(list(zip(groups, before)), f"{GROUP} long, {OFFSET} long")
    # 16 bytes a group: a few MB at the bound. More groups than that are joined by shuffle.
    return F.broadcast(frame) if len(groups) <= MOST_BLOCKS else frame


def offsets_of(counts: DataFrame, start: int) -> tuple[DataFrame, int]:
    """First number minus one of each group, from a frame of (group, n), and the last number.

    The counts are staged with the sums inside their span; that is all that is read of the rows.
    """
    spark = counts.sparkSession
    before = Window.partitionBy("_span").orderBy(GROUP).rowsBetween(Window.unboundedPreceding, -1)
    spans = counts.withColumn("_span", F.expr(f"{GROUP} div {SPAN}"))
    placed = stage(spans.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0))), "counts")
    totals = {r["_span"]: r["n"] for r in placed.groupBy("_span").agg(F.sum("n").alias("n")).collect()}
    bases = list(zip(sorted(totals), accumulate((totals[s] for s in sorted(totals)), initial=start)))
    base = F.broadcast(spark.createDataFrame(bases, "_span long, _base long"))
    offsets = placed.join(base, "_span").select(GROUP, (F.col("_base") + F.col("_before")).alias(OFFSET))
    # There are at most MOST_BLOCKS groups, of 16 bytes each.
    return F.broadcast(offsets), start + sum(totals.values())


def running_totals(df: DataFrame, order: list[str], n: str, out: str) -> tuple[DataFrame, int]:
    """Adds to each row the sum of `n` over all rows before it, by any total order; and the sum of all.

    Rows are range partitioned and staged, as in `assign_keys_by_range`; one total for each partition reaches the driver.
    """
    spark = df.sparkSession
    placed = stage(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(POSITION, F.monotonically_increasing_id()), "placed"
    ).withColumn(GROUP, F.shiftright(POSITION, 33))
    totals = {r[GROUP]: r[n] for r in placed.groupBy(GROUP).agg(F.sum(n).alias(n)).collect()}
    before = Window.partitionBy(GROUP).orderBy(POSITION).rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum(n).over(before), F.lit(0))
    added = placed.withColumn(out, within).join(offsets_frame(spark, totals, 0), GROUP)
    return added.withColumn(out, F.col(out) + F.col(OFFSET)).drop(GROUP, OFFSET, POSITION), sum(totals.values())


def group_counts(df: DataFrame, group: Column) -> dict[int, int]:
    rows = df.groupBy(group.alias(GROUP)).count().collect()
    return {r[GROUP]: r["count"] for r in rows}


def number_in_groups(df: DataFrame, group: Column, order: list, offsets: DataFrame, out: str) -> DataFrame:
    """Add `out` = offset of the group + rank by `order`.

    `group` must rise with `order`, and no group may be too large for a task.
    The result depends on the data alone, so a lost task is simply run again.
    """
    within = Window.partitionBy(GROUP).orderBy(*order)
    return (
        df.withColumn(GROUP, group)
        .withColumn(out, F.row_number().over(within).cast("long"))
        .join(offsets, GROUP)
        .withColumn(out, F.col(out) + F.col(OFFSET))
        .drop(GROUP, OFFSET)
    )


@dataclass(frozen=True)
class IdRange:
    """Rows, least and greatest id, and a check sum of the ids."""

    rows: int
    low: int | None
    high: int | None
    ids: int | None

    @staticmethod
    def columns(id_column: str) -> list[Column]:
        ids = F.col(id_column)
        return [F.count(ids), F.min(ids), F.max(ids), F.bit_xor(F.xxhash64(ids.cast("long")))]

    @staticmethod
    def of(df: DataFrame, id_column: str) -> "IdRange":
        return IdRange(*df.agg(*IdRange.columns(id_column)).first())

    def dense(self, spark) -> bool:
        """Whether the ids are each number of the range, once."""
        if self.rows != self.high - self.low + 1:
            return False
        every = spark.range(self.low, self.high + 1).agg(F.bit_xor(F.xxhash64("id")))
        return every.first()[0] == self.ids


def assign_keys(
    df: DataFrame,
    order: str,
    start: int,
    out: str,
    then: tuple[str, ...] = (),
    found: IdRange | None = None,
    same_ids: DataFrame | None = None,
    gather: bool = False,
) -> tuple[DataFrame, int]:
    """Number rows by the long column `order` (nearly unique), then by `then`.

    Returns the rows with `out`, and the last number given. Ids without gaps
    are numbered by subtraction, with no shuffle, unless `gather` asks for
    neighbouring numbers in the same task. `found` is the range of `order`, if
    it is known; `same_ids` is a frame with the same values of `order` that is
    cheaper to count than `df`.
    """
    spark = df.sparkSession
    counted = df if same_ids is None else same_ids
    found = found or IdRange.of(counted, order)
    if not found.rows:
        return df.withColumn(out, F.lit(None).cast("long")), start
    if not (then or gather) and found.dense(spark):
        return df.withColumn(out, F.col(order) - F.lit(found.low) + F.lit(start + 1)), start + found.rows
    width = block_width(spark, found.low, found.high)
    group = F.expr(f"`{order}` div {width}")
    offsets, last = offsets_of(counted.groupBy(group.alias(GROUP)).agg(F.count(F.lit(1)).alias("n")), start)
    return number_in_groups(df, group, [order, *then], offsets, out), last


def assign_keys_by_range(df: DataFrame, order: list, start: int, out: str) -> tuple[DataFrame, int]:
    """Number rows by any total order, also one with heavily repeated leading values.

    Rows are range partitioned by the whole order and written once; the
    position of each row in its partition is stored with it, so the numbers
    stay the same however often they are read.
    """
    staged = stage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(POSITION, F.monotonically_increasing_id()),
        "numbered",
    )
    # monotonically_increasing_id: partition in the upper 31 bits, row in the lower 33.
    part = F.shiftright(POSITION, 33)
    counts = group_counts(staged, part)
    numbered = (
        staged.withColumn(GROUP, part)
        .join(offsets_frame(df.sparkSession, counts, start), GROUP)
        .withColumn(out, F.col(OFFSET) + F.col(POSITION).bitwiseAND((1 << 33) - 1) + 1)
        .drop(GROUP, OFFSET, POSITION)
    )
    return numbered, start + sum(counts.values())
