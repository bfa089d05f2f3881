"""The incremental cycle: changed source rows into the star."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.operators import star
from tallyfold.operators.incremental import advance_marks, changed_since, seed_marks
from tallyfold.operators.keys import IdRange, assign_keys
from tallyfold.operators.merge import insert_ignore, latest_per_key, one_per_key, upsert
from tallyfold.schemas import SOURCE_TABLES, star_tables
from tallyfold.session import scratch, side_by_side, stage
from tallyfold.sources.store import BLOCK, MONTH, TableStore, Transaction

MARK_TABLE = "etl_watermarks"
DIMENSION_STREAMS = ("clients", "sellers", "products")
FACT_STREAMS = ("invoices", "invoice_items", "payments")


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def open_star(
    spark: SparkSession, root: str, mode: str = "idempotent", block_rows: int = 1 << 20, period: str = MONTH
) -> TableStore:
    """The star at `root`. `mode` is `idempotent` or `append` (see `append_fact`); appended facts lie by the `period`
    of their stamp."""
    return TableStore(spark, root, star_tables(mode), block_rows, period=period)


def init_star(store: TableStore) -> None:
    """Create the eight tables that do not exist yet."""
    tx = store.begin()
    missing = [t for t in store.tables if not tx.exists(t)]
    for table in missing:
        tx.create(table)
    if missing:
        tx.commit()


def init_marks(store: TableStore) -> None:
    """Add the six marks at 1900-01-01; a mark that exists stays."""
    tx = store.begin()
    new = insert_ignore(tx.read(MARK_TABLE), seed_marks(store.spark), "stream_name")
    tx.append(MARK_TABLE, new.coalesce(1))
    tx.commit()


def reset_star(store: TableStore) -> None:
    """Publish a version in which all eight tables are empty."""
    tx = store.begin()
    for table in store.tables:
        tx.clear(table)
    tx.commit()


@dataclass
class Load:
    """What one cycle works with.

    `source` is a store of the source tables, of which only folders with new
    rows are read, or a function from stream name to DataFrame. `overlap` is subtracted
    from the marks to catch rows committed late. `newest_only` keeps the newest
    row of each key, for sources that hold several versions of a row, and leaves
    alone what the star has from a newer one. `every_row` takes all rows of the
    source whatever their stamp, those without one included, for sources that
    give each row once. `batch` names the source and numbers what it gives: a
    number is published with the rows, and one that is not beyond the published
    number loads nothing.
    `on_unresolved` receives the rows that found no dimension row.
    """

    star: TableStore
    source: TableStore | Callable[[str], DataFrame]
    overlap: timedelta = timedelta(0)
    newest_only: bool = False
    every_row: bool = False
    on_unresolved: Callable[[str, DataFrame], None] | None = None
    batch: tuple[str, int] | None = None
    rows: dict[str, int] = field(default_factory=dict)
    _marks: tuple[Transaction | None, dict[str, datetime]] = (None, {})

    @property
    def idempotent(self) -> bool:
        return "item_id" in self.star.tables["fact_invoice_item"].names

    def low(self, tx: Transaction, stream: str) -> datetime | None:
        """Stamp from which rows of a stream are read; None without a mark."""
        if self._marks[0] is not tx:
            self._marks = (tx, {r[0]: r[1] for r in tx.read(MARK_TABLE).collect()})
        mark = self._marks[1].get(stream)
        return None if mark is None else mark - self.overlap

    def changes(self, tx: Transaction, stream: str, column: str) -> DataFrame:
        low = self.low(tx, stream)
        if low is None:
            return tx.spark.createDataFrame([], SOURCE_TABLES[stream].schema)
        if self.every_row:
            return self.source.read(stream) if isinstance(self.source, TableStore) else self.source(stream)
        if isinstance(self.source, TableStore):
            rows = self.source.read(stream, since=low.isoformat(sep=" "))
        else:
            rows = self.source(stream)
        return changed_since(rows, column, low)


def _load_dimension(load: Load, tx: Transaction, stream: str, table: str, project) -> None:
    batch = project(load.changes(tx, stream, "updated_at"))
    if load.newest_only:
        batch = latest_per_key(batch, tx.table(table).natural_key, "updated_at")
    load.rows[table] = upsert(tx, table, stage(batch, table), newer=load.newest_only)


def load_dim_client(load: Load, tx: Transaction) -> None:
    _load_dimension(load, tx, "clients", "dim_client", star.project_client)


def load_dim_seller(load: Load, tx: Transaction) -> None:
    _load_dimension(load, tx, "sellers", "dim_seller", star.project_seller)


def load_dim_product(load: Load, tx: Transaction) -> None:
    _load_dimension(load, tx, "products", "dim_product", star.project_product)


def ensure_dates(tx: Transaction, dates: DataFrame) -> None:
    """Add the dates that the date dimension lacks."""
    new = star.missing_dates(tx.read("dim_date"), dates)
    tx.append("dim_date", new.repartition(1))


def load_fact_invoice(load: Load, tx: Transaction) -> None:
    changed = load.changes(tx, "invoices", "updated_at")
    if load.newest_only or load.on_unresolved:
        changed = stage(changed, "invoices")
    if load.newest_only:
        changed = one_per_key(changed, "invoice_id", lambda rows: latest_per_key(rows, "invoice_id", "updated_at"))
    sellers, clients = tx.read("dim_seller"), tx.read("dim_client")
    if load.on_unresolved:
        load.on_unresolved("invoices", star.unresolved_invoices(changed, sellers, clients))
    # Staged once: dates, counts, the merge and the new rows all read what was read and joined here.
    resolved = stage(star.resolve_invoice_keys(changed, sellers, clients), "resolved")
    ensure_dates(tx, resolved.select("invoice_date"))
    load.rows["fact_invoice"] = upsert(tx, "fact_invoice", star.project_invoice(resolved), newer=load.newest_only)


def append_fact(load: Load, tx: Transaction, table: str, stream: str, rows: DataFrame, source_id: str) -> int:
    """Append rows to a fact, numbered in order of their source id.

    In append mode a row read twice is stored twice. In idempotent mode rows
    whose source id is stored are left out; a stored copy carries the same
    creation stamp, so only the periods that the rows name are searched, however
    old one of them is. Rows without a stamp have a place of their own and are
    stored once, too. The rows are read several times and should be staged; they
    are counted and numbered as stored there.
    """
    key = tx.table(table).key
    if load.idempotent:
        if load.newest_only:
            rows = one_per_key(rows, source_id, lambda some: some.dropDuplicates([source_id]))
        periods = tx.blocks_of(table, rows)
        if periods:
            at = tx.block_of(table).alias(BLOCK)
            stored = tx.read(table, periods).select(at, source_id)
            rows = stage(rows.select("*", at).join(stored, [BLOCK, source_id], "left_anti").drop(BLOCK), table)
    found = IdRange.of(rows, source_id)
    if not found.rows:
        return 0
    numbered, last = assign_keys(rows, source_id, tx.high_key(table), key, found=found)
    tx.append(table, numbered)
    tx.raise_high_key(table, last)
    return found.rows


def load_fact_item(load: Load, tx: Transaction) -> None:
    changed = load.changes(tx, "invoice_items", "created_at")
    products = tx.read("dim_product")
    if load.on_unresolved:
        changed = stage(changed, "items")
        load.on_unresolved("invoice_items", star.unresolved_items(changed, products))
    rows = stage(star.project_item(star.resolve_item_keys(changed, products)), "items")
    load.rows["fact_invoice_item"] = append_fact(load, tx, "fact_invoice_item", "invoice_items", rows, "item_id")


def load_fact_payment(load: Load, tx: Transaction) -> None:
    changed = stage(load.changes(tx, "payments", "created_at"), "payments")
    ensure_dates(tx, changed.select("payment_date"))
    rows = star.project_payment(changed)
    load.rows["fact_payment"] = append_fact(load, tx, "fact_payment", "payments", rows, "payment_id")


def _advance(tx: Transaction, streams, batch_ts) -> None:
    tx.replace(MARK_TABLE, advance_marks(tx.read(MARK_TABLE), streams, batch_ts).coalesce(1))


def _fresh(load: Load, tx: Transaction, group: str) -> bool:
    """Whether the batch of the load is still to be loaded; notes its number, to be published with the rows."""
    if load.batch is None:
        return True
    source, number = load.batch
    last = tx.noted(f"{source}/{group}")
    tx.note(f"{source}/{group}", number)
    return last is None or number > last


def load_dimensions(load: Load, batch_ts: datetime | str | None = None) -> int:
    """All dimensions and their marks, published together."""
    batch_ts = batch_ts or utc_now()
    with scratch(load.star.spark):
        tx = load.star.begin()
        if not _fresh(load, tx, "dimensions"):
            return load.star.latest()
        side_by_side(
            lambda: load_dim_client(load, tx),
            lambda: load_dim_seller(load, tx),
            lambda: load_dim_product(load, tx),
        )
        _advance(tx, DIMENSION_STREAMS, batch_ts)
        return tx.commit()


def load_facts(load: Load, batch_ts: datetime | str | None = None) -> int:
    """All facts, their dates and their marks, published together."""
    batch_ts = batch_ts or utc_now()
    with scratch(load.star.spark):
        tx = load.star.begin()
        if not _fresh(load, tx, "facts"):
            return load.star.latest()

        def dated() -> None:
            # One after the other, as both add to the date dimension.
            load_fact_invoice(load, tx)
            load_fact_payment(load, tx)

        side_by_side(dated, lambda: load_fact_item(load, tx))
        _advance(tx, FACT_STREAMS, batch_ts)
        return tx.commit()


def run_cycle(
    load: Load, batch_ts: datetime | str | None = None, retries: int = 1, retry_delay: float = 120.0
) -> dict[str, int]:
    """Dimensions, then facts. `batch_ts` becomes the new mark; by default the
    time at the start of each group. A failed group is tried again after a
    delay; nothing of the failed try was published. Returns rows per table."""
    for group in (load_dimensions, load_facts):
        for attempt in range(retries + 1):
            try:
                group(load, batch_ts)
                break
            except Exception:
                if attempt == retries:
                    raise
                time.sleep(retry_delay)
    return dict(load.rows)
