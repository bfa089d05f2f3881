"""Upsert, insert-if-absent and find-or-create as joins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.operators.keys import assign_keys, group_counts, number_in_groups, offsets_frame
from tallyfold.session import stage
from tallyfold.sources.store import BLOCK, Transaction

# Largest batch sent to every executor; its size is measured first. The driver holds a few times as much, and several
# tables are loaded side by side.
BROADCAST_BYTES = 16 << 20
FEW_KEYS = 1 << 19  # repeated keys sent to every executor, some tens of MB
MATCHED = "_matched"


class DuplicateKeyError(ValueError):
    """An upsert batch names one key more than once."""


def first_per_key(df: DataFrame, key: str, order: Column) -> DataFrame:
    """The row with the least `order` for each key.

    An aggregate, not a window: each task keeps one row per key before the
    shuffle, so a key that holds most rows is no heavier than any other.
    """
    rest = [c for c in df.columns if c != key]
    first = F.min_by(F.struct(*rest), order).alias("_first")
    return df.groupBy(key).agg(first).select(key, *(F.col(f"_first.`{c}`").alias(c) for c in rest))


def first_rows(df: DataFrame, key: str, order: str, then: str | None = None, staged: bool = False) -> DataFrame:
    """The row with the least place for each key; the long `order`, with the int `then`, identifies a row.

    Only key and place are aggregated, which one number per key and task can do in a hash table; the rows are then
    fetched by their place, wherever they lie. Nothing is sorted. With `staged` the places are written first: while they
    are few by measured size, the rows are then scanned and not shuffled.
    """
    place = F.col(order)
    if then:
        place = (place.cast("decimal(20,0)") * F.lit(1 << 31) + F.col(then)).cast("decimal(38,0)")
    placed = df.withColumn("_place", place)
    least = placed.groupBy(key).agg(F.min("_place").alias("_place")).select("_place")
    return placed.join(stage(least, "least") if staged else least, "_place", "left_semi").select(*df.columns)


def latest_per_key(df: DataFrame, key: str, stamp_column: str) -> DataFrame:
    """The newest row of each key; rows with one stamp are ranked by their values."""
    rest = [c for c in df.columns if c != key]
    last = F.max_by(F.struct(*rest), F.struct(stamp_column, *rest)).alias("_last")
    return df.groupBy(key).agg(last).select(key, *(F.col(f"_last.`{c}`").alias(c) for c in rest)).select(*df.columns)


def one_per_key(rows: DataFrame, key: str, pick: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Staged `rows` with a single row for each key: `pick` chooses among those that share one, nulls included.

    Only keys are shuffled to find those that repeat. Usually none does, and the rows stay where they are; few are
    broadcast, and their rows alone go through `pick`; beyond that all rows do. What is returned is staged, too.
    """
    again = stage(rows.groupBy(F.col(key).alias("_again")).count().where("count > 1").select("_again"), "again")
    n = again.count()
    if not n:
        return rows
    if n > FEW_KEYS:
        return stage(pick(rows), "single")
    same = F.col(key).eqNullSafe(F.col("_again"))
    alone = rows.join(F.broadcast(again), same, "left_anti")
    return stage(alone.unionByName(pick(rows.join(F.broadcast(again), same, "left_semi"))), "single")


def insert_ignore(target: DataFrame, batch: DataFrame, key: str, order: Column | None = None) -> DataFrame:
    """Rows of the batch that an insert would add: first of each key, unknown to the target."""
    rows = first_per_key(batch, key, order) if order is not None else batch.dropDuplicates([key])
    return rows.join(target.select(key), key, "left_anti").select(*batch.columns)


def lookup_ids(df: DataFrame, table: DataFrame, natural_key: str, id_column: str) -> DataFrame:
    """Add the id of the row with the same natural key; NULL when there is none."""
    return df.join(table.select(natural_key, id_column), natural_key, "left")


def known_rows(table: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Rows of the table whose key occurs in `rows`.

    The table is the streamed side: when `rows` are few by measured size they
    are broadcast and the table, however large, is scanned without a shuffle.
    """
    return table.join(rows.select(key), key, "left_semi").select(*table.columns)


def get_or_create(
    existing: DataFrame,
    candidates: DataFrame,
    natural_key: str,
    order: str,
    id_column: str,
    start: int,
    then: tuple[str, ...] = (),
) -> tuple[DataFrame, int]:
    """New rows for natural keys that do not exist yet, numbered in input order.

    Attributes come from the first candidate of each key, by `order` and then
    by `then`, and are never refreshed. Returns the new rows (with `order` and
    `then`) and the last id given. The first candidates are staged: they are
    read more than once, and their size is then known to the planner.
    """
    firsts = _first_candidates(candidates, natural_key, order, then)
    new = firsts.join(known_rows(existing.select(natural_key), firsts, natural_key), natural_key, "left_anti")
    return assign_keys(new, order, start, id_column, then)


def _first_candidates(candidates: DataFrame, natural_key: str, order: str, then: tuple[str, ...]) -> DataFrame:
    place = F.struct(order, *then) if then else F.col(order)
    named = candidates.where(F.col(natural_key).isNotNull())
    return stage(first_per_key(named, natural_key, place), "firsts")


def find_or_create(
    tx: Transaction,
    name: str,
    candidates: DataFrame,
    order: str,
    then: tuple[str, ...] = (),
    complete: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """`get_or_create` on a stored table: ids by natural key for all candidates.

    Ids are found through the index of the natural key, of which only the
    blocks of the candidates are opened; the result is no larger than the
    candidates. `order`, with the int column `then` if there is
    one, identifies a candidate. `complete` adds the remaining columns to the
    new rows.
    """
    table = tx.table(name)
    natural_key, id_column = table.natural_key, table.key
    named = candidates.where(F.col(natural_key).isNotNull())
    firsts = stage(first_rows(named, natural_key, order, *then, staged=True), "firsts")
    known = known_rows(tx.ids_of(name, firsts), firsts, natural_key)
    known = stage(known.groupBy(natural_key).agg(F.min(id_column).alias(id_column)), "known")
    new = firsts.join(known, natural_key, "left_anti")
    keyed, last = assign_keys(complete(new), order, tx.high_key(name), id_column, then, same_ids=new, gather=True)
    added = tx.append(name, keyed)
    tx.raise_high_key(name, last)
    return known.unionByName(added.select(natural_key, id_column))


def merged(
    target: DataFrame,
    batch: DataFrame,
    key: str,
    refresh: tuple[str, ...],
    on: list[str] | None = None,
    newer: bool = False,
) -> DataFrame:
    """Target rows with `refresh` taken from the matching batch row, if any.

    The match is told by a flag, so a NULL that comes in does overwrite. With
    `newer`, a batch row older than the target row (`updated_at`) does not.
    """
    on = on or [key]
    takes = F.col(MATCHED)
    if newer:
        takes &= F.coalesce(F.col("_new_updated_at") >= F.col("updated_at"), F.lit(True))
    incoming = batch.select(*on, *(F.col(c).alias(f"_new_{c}") for c in refresh), F.lit(True).alias(MATCHED))
    joined = target.join(incoming, on, "left")
    return joined.select(
        *(
            F.when(takes, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in refresh else F.col(c)
            for c in target.columns
        )
    )


def upsert_frame(target: DataFrame, batch: DataFrame, key: str, refresh: tuple[str, ...]) -> DataFrame:
    """Upsert between two DataFrames of the same columns; nothing is stored or numbered."""
    fresh = batch.join(target.select(key), key, "left_anti").select(*target.columns)
    return merged(target, batch, key, refresh).unionByName(fresh)


def row_bytes(df: DataFrame) -> Column:
    """Size of a row: text as it is, 16 bytes for any other value."""
    total = F.lit(0)
    for f in df.schema:
        total = total + (F.coalesce(F.octet_length(f.name), F.lit(0)) + 16 if f.dataType.typeName() == "string" else 16)
    return total


def upsert(tx: Transaction, name: str, batch: DataFrame, newer: bool = False) -> int:
    """Upsert a batch into a stored table; returns the number of batch rows.

    The batch is read several times and should be staged. `newer`: see `merged`.

    Known rows get the table's `refresh` columns and keep all others,
    surrogate key included. New rows are numbered after the highest key, in
    order of their natural key. Only blocks that the batch touches are read
    or written.
    """
    table = tx.table(name)
    key, surrogate = table.natural_key, table.key
    block = tx.block_of(name, key)

    # One row per key after the first step, so a repeated key shows as n > 1.
    # The size of the batch matters only when there is something to join it to.
    size = row_bytes(batch) if tx.blocks(name) else F.lit(0)
    profile = (
        batch.groupBy(key)
        .agg(F.count("*").alias("n"), F.sum(size).alias("bytes"))
        .groupBy(block.alias(BLOCK))
        .agg(F.sum("n").alias("rows"), F.count("*").alias("keys"), F.sum("bytes").alias("bytes"))
        .collect()
    )
    if any(p["rows"] != p["keys"] for p in profile):
        raise DuplicateKeyError(f"{name}: the batch repeats a value of {key}")
    if any(p[BLOCK] is None for p in profile):
        raise ValueError(f"{name}: the batch has rows without {key}")
    counts = {p[BLOCK]: p["rows"] for p in profile}
    total = sum(counts.values())
    known_blocks = tx.blocks(name) & set(counts)
    small = sum(p["bytes"] for p in profile) <= BROADCAST_BYTES

    new = batch
    if known_blocks:
        target = tx.read(name, known_blocks)
        if small:
            hits = target.select(key).join(F.broadcast(batch.select(key)), key, "left_semi")
            new = batch.join(hits, key, "left_anti")
        else:
            new = batch.join(target.select(key), key, "left_anti")
        counts = group_counts(new, block)

    start = tx.high_key(name)
    numbered = number_in_groups(new, block, [key], offsets_frame(tx.spark, counts, start), surrogate) if counts else None

    if known_blocks:
        if small:
            # Each task rewrites the block files it scans; nothing is shuffled.
            kept = merged(target, F.broadcast(batch), key, table.refresh, newer=newer)
        else:
            # Both sides arrive by block, which is also how the result is written.
            kept = merged(
                target.withColumn(BLOCK, block).repartition(BLOCK),
                batch.withColumn(BLOCK, block).repartition(BLOCK),
                key,
                table.refresh,
                [BLOCK, key],
                newer,
            )
        tx.rewrite_blocks(name, kept, known_blocks)
    if numbered is not None:
        tx.append(name, numbered)
        tx.raise_high_key(name, start + sum(counts.values()))
    return total
