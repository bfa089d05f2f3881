"""Sums of a column for each parent, kept up to date by whatever changes the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.schemas import Totals
from tallyfold.session import stage
from tallyfold.sources.store import Transaction


def add(tx: Transaction, name: str, rows: DataFrame) -> None:
    """Rows have been added to the table."""
    _change(tx, name, [(rows, 1)])


def remove(tx: Transaction, name: str, rows: DataFrame) -> None:
    _change(tx, name, [(rows, -1)])


def replace(tx: Transaction, name: str, old: DataFrame, new: DataFrame) -> None:
    _change(tx, name, [(old, -1), (new, 1)])


def _change(tx: Transaction, name: str, parts: list[tuple[DataFrame, int]]) -> None:
    """Adds the changes to the sums of the parents they name, and to no others; only the blocks of these are opened.

    A parent without rows has no sum. Tables without declared totals are left alone, as is a store that keeps none.
    """
    totals = tx.table(name).totals
    if totals is None or totals.table not in tx.store.tables:
        return
    changes = [_signed(rows, totals, sign) for rows, sign in parts]
    union = changes[0]
    for change in changes[1:]:
        union = union.unionByName(change)
    kept = tx.table(totals.table)
    by, count, amount = kept.names
    sums = union.groupBy(by).agg(F.sum(count).alias(count), F.sum(amount).alias(amount))
    sums = stage(sums.where((F.col(count) != 0) | (F.col(amount) != 0)), "changes")
    blocks = tx.blocks_of(totals.table, sums)
    both = tx.read(totals.table, blocks).unionByName(sums.select(*(F.col(c.name).cast(c.type) for c in kept.columns)))
    now = both.groupBy(by).agg(F.sum(count).alias(count), F.sum(amount).alias(amount)).where(F.col(count) > 0)
    rows = now.select(*(F.col(c.name).cast(c.type) for c in kept.columns))
    tx.rewrite_blocks(totals.table, tx.gather_blocks(totals.table, rows), blocks)


def _signed(rows: DataFrame, totals: Totals, sign: int) -> DataFrame:
    return rows.select(
        F.col(totals.by).cast("long").alias("invoice_id"),
        F.lit(sign).cast("long").alias("payments"),
        (F.col(totals.amount) * sign).cast("decimal(24,2)").alias("paid"),
    )


def of(tx: Transaction, name: str, parents: DataFrame) -> DataFrame:
    """Sums kept for the rows of the table, of the blocks that the parents lie in."""
    totals = tx.table(name).totals
    return tx.read(totals.table, tx.blocks_of(totals.table, parents))
