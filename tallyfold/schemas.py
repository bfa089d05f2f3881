"""Tables of the source model and of the star, with their declared rules."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

NOW = object()    # default: the time of the statement
TODAY = object()  # default: its date
NO_DEFAULT = object()

TEXT = T.StringType()
LONG = T.LongType()
INT = T.IntegerType()
DATE = T.DateType()
STAMP = T.TimestampNTZType()


def money(precision: int) -> T.DecimalType:
    return T.DecimalType(precision, 2)


@dataclass(frozen=True)
class Column:
    name: str
    type: T.DataType
    required: bool = False
    max_length: int | None = None
    default: object = NO_DEFAULT


@dataclass(frozen=True)
class Reference:
    column: str
    parent: str
    parent_column: str
    on_delete: str = "restrict"


@dataclass(frozen=True)
class Totals:
    """For each value of `by` the number of rows and the sum of `amount`, in `table`."""

    table: str
    by: str
    amount: str


RANGE, HASH, PERIOD = "range", "hash", "period"


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]
    key: str
    unique: tuple[str, ...] = ()
    checks: dict[str, str] = field(default_factory=dict)
    references: tuple[Reference, ...] = ()
    # Unique business key by which rows are upserted or looked up.
    natural_key: str | None = None
    # Columns that an upsert refreshes; all others keep their first value.
    refresh: tuple[str, ...] = ()
    # Column by which stored rows are grouped into blocks, and how: RANGE puts neighbouring ids together, HASH spreads
    # the values over a fixed number of blocks, PERIOD has a block for each month or day.
    block_by: str | None = None
    layout: str = RANGE
    # Sums that are kept up to date with the rows of this table.
    totals: Totals | None = None

    @property
    def indexed(self) -> bool:
        """Whether the natural key says nothing about the block, so that finding a row by it needs an index."""
        return self.natural_key is not None and self.natural_key != self.block_by

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type, True) for c in self.columns])

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def stamp(self) -> str | None:
        """Column that tells when a row last changed."""
        return next((c for c in ("updated_at", "created_at") if c in self.names), None)

    def column(self, name: str) -> Column:
        return next(c for c in self.columns if c.name == name)


STAMPS = (Column("created_at", STAMP, default=NOW), Column("updated_at", STAMP, default=NOW))


def _party(name: str, singular: str) -> Table:
    return Table(
        name,
        (
            Column(f"{singular}_id", LONG, True),
            Column(f"{singular}_name", TEXT, True, 255),
            Column(f"{singular}_address", TEXT, True),
            Column(f"{singular}_tax_id", TEXT, True, 30),
            Column("iban", TEXT, max_length=50),
            *STAMPS,
        ),
        key=f"{singular}_id",
        unique=(f"{singular}_tax_id",),
        natural_key=f"{singular}_tax_id",
        block_by=f"{singular}_id",
    )


CLIENTS = _party("clients", "client")
SELLERS = _party("sellers", "seller")

PRODUCTS = Table(
    "products",
    (
        Column("product_id", LONG, True),
        Column("product_name", TEXT, True, 255),
        Column("product_description", TEXT),
        Column("unit_price", money(12), True),
        Column("vat_rate", money(5), default="10.00"),
        *STAMPS,
    ),
    key="product_id",
    natural_key="product_name",
    block_by="product_id",
)

INVOICES = Table(
    "invoices",
    (
        Column("invoice_id", LONG, True),
        Column("invoice_no", TEXT, True, 50),
        Column("invoice_date", DATE, True),
        Column("seller_id", LONG, True),
        Column("client_id", LONG, True),
        Column("total_net_worth", money(14), default="0.00"),
        Column("total_vat", money(14), default="0.00"),
        Column("total_gross_worth", money(14), default="0.00"),
        Column("status", TEXT, max_length=20, default="UNPAID"),
        *STAMPS,
    ),
    key="invoice_id",
    unique=("invoice_no",),
    natural_key="invoice_no",
    references=(
        Reference("seller_id", "sellers", "seller_id", "cascade"),
        Reference("client_id", "clients", "client_id", "cascade"),
    ),
    block_by="invoice_id",
)

INVOICE_ITEMS = Table(
    "invoice_items",
    (
        Column("item_id", LONG, True),
        Column("invoice_id", LONG, True),
        Column("product_id", LONG, True),
        Column("item_qty", money(10), True),
        Column("item_net_price", money(12), True),
        Column("item_net_worth", money(12)),
        Column("item_vat_rate", money(5), default="10.00"),
        Column("item_gross_worth", money(12)),
        Column("created_at", STAMP, default=NOW),
    ),
    key="item_id",
    checks={"item_qty_positive": "item_qty > 0"},
    references=(
        Reference("invoice_id", "invoices", "invoice_id", "cascade"),
        Reference("product_id", "products", "product_id", "restrict"),
    ),
    # Children lie with their parent, as an index on the parent's id would have it.
    block_by="invoice_id",
    layout=HASH,
)

PAYMENTS = Table(
    "payments",
    (
        Column("payment_id", LONG, True),
        Column("invoice_id", LONG, True),
        Column("payment_date", DATE, True, default=TODAY),
        Column("payment_method", TEXT, max_length=50),
        Column("payment_reference", TEXT, max_length=100),
        Column("amount", money(14), True),
        Column("remarks", TEXT),
        Column("created_at", STAMP, default=NOW),
    ),
    key="payment_id",
    checks={
        "payment_method_known": "payment_method IN ('CASH', 'BANK_TRANSFER', 'CREDIT_CARD', 'CHECK', 'ONLINE')",
        "amount_positive": "amount > 0",
    },
    references=(Reference("invoice_id", "invoices", "invoice_id", "cascade"),),
    block_by="invoice_id",
    layout=HASH,
    totals=Totals("payment_totals", "invoice_id", "amount"),
)

# What has been paid for each invoice that has payments.
PAYMENT_TOTALS = Table(
    "payment_totals",
    (Column("invoice_id", LONG, True), Column("payments", LONG, True), Column("paid", money(24), True)),
    key="invoice_id",
    block_by="invoice_id",
)


def key_index(table: Table) -> Table:
    """(natural key, id) of a table, grouped by a hash of the natural key."""
    columns = (table.column(table.natural_key), table.column(table.key))
    return Table(f"{table.name}_by_{table.natural_key}", columns, table.key, block_by=table.natural_key, layout=HASH)


# Input lines that the ingest refused, with the reason.
REJECTED_LINES = Table(
    "rejected_lines",
    (
        Column("load_id", TEXT, True),
        Column("line_no", LONG, True),
        Column("reason", TEXT, True),
        Column("line", TEXT),
    ),
    key="line_no",
)

# Items that were left out of an accepted line, with the reason.
REJECTED_ITEMS = Table(
    "rejected_items",
    (
        Column("load_id", TEXT, True),
        Column("line_no", LONG, True),
        Column("pos", LONG, True),
        Column("product_name", TEXT),
        Column("reason", TEXT, True),
    ),
    key="line_no",
)

# Payments that name no known invoice or break a rule, with the reason; values as text, as they may fit no column.
REJECTED_PAYMENTS = Table(
    "rejected_payments",
    (
        Column("load_id", TEXT, True),
        Column("invoice_no", TEXT),
        Column("payment_date", TEXT),
        Column("payment_method", TEXT),
        Column("payment_reference", TEXT),
        Column("amount", TEXT),
        Column("reason", TEXT, True),
    ),
    key="invoice_no",
)

SOURCE_TABLES: dict[str, Table] = {
    t.name: t for t in (CLIENTS, SELLERS, PRODUCTS, INVOICES, INVOICE_ITEMS, PAYMENTS)
}
INGEST_TABLES: dict[str, Table] = {
    **SOURCE_TABLES,
    **{t.name: t for t in (PAYMENT_TOTALS, REJECTED_LINES, REJECTED_ITEMS, REJECTED_PAYMENTS)},
}

# The six streams and the time their marks start at.
STREAMS = ("clients", "sellers", "products", "invoices", "invoice_items", "payments")
FIRST_MARK = "1900-01-01 00:00:00"

MARKS = Table(
    "etl_watermarks",
    (Column("stream_name", TEXT, True), Column("last_loaded_ts", STAMP, True)),
    key="stream_name",
)

DIM_DATE = Table(
    "dim_date",
    (
        Column("date_key", INT, True),
        Column("date", DATE, True),
        Column("year", INT),
        Column("quarter", INT),
        Column("month", INT),
        Column("month_name", TEXT),
        Column("day", INT),
        Column("day_of_week", INT),
        Column("day_name", TEXT),
        Column("week_of_year", INT),
    ),
    key="date_key",
    unique=("date",),
)


def _party_dimension(singular: str) -> Table:
    attributes = (f"{singular}_name", f"{singular}_addr", f"{singular}_tax_id", "iban", "updated_at")
    return Table(
        f"dim_{singular}",
        (
            Column(f"{singular}_key", LONG, True),
            Column(f"{singular}_id", LONG, True),
            Column(f"{singular}_name", TEXT, True),
            Column(f"{singular}_addr", TEXT),
            Column(f"{singular}_tax_id", TEXT),
            Column("iban", TEXT),
            Column("updated_at", STAMP, default=NOW),
        ),
        key=f"{singular}_key",
        unique=(f"{singular}_id",),
        natural_key=f"{singular}_id",
        refresh=attributes,
        block_by=f"{singular}_id",
    )


DIM_CLIENT = _party_dimension("client")
DIM_SELLER = _party_dimension("seller")

DIM_PRODUCT = Table(
    "dim_product",
    (
        Column("product_key", LONG, True),
        Column("product_id", LONG, True),
        Column("product_name", TEXT, True),
        Column("product_desc", TEXT),
        Column("unit_price", money(12)),
        Column("vat_rate", money(5)),
        Column("updated_at", STAMP, default=NOW),
    ),
    key="product_key",
    unique=("product_id",),
    natural_key="product_id",
    # The description is set once and not refreshed.
    refresh=("product_name", "unit_price", "vat_rate", "updated_at"),
    block_by="product_id",
)

FACT_INVOICE = Table(
    "fact_invoice",
    (
        Column("invoice_key", LONG, True),
        Column("invoice_id", LONG, True),
        Column("invoice_no", TEXT, True),
        Column("invoice_date_key", INT),
        Column("seller_key", LONG),
        Column("client_key", LONG),
        Column("total_net", money(14)),
        Column("total_vat", money(14)),
        Column("total_gross", money(14)),
        Column("status", TEXT),
        Column("updated_at", STAMP),
    ),
    key="invoice_key",
    unique=("invoice_id",),
    natural_key="invoice_id",
    refresh=("total_gross", "status", "updated_at"),
    references=(
        Reference("invoice_date_key", "dim_date", "date_key"),
        Reference("seller_key", "dim_seller", "seller_key"),
        Reference("client_key", "dim_client", "client_key"),
    ),
    block_by="invoice_id",
)

FACT_INVOICE_ITEM = Table(
    "fact_invoice_item",
    (
        Column("invoice_item_key", LONG, True),
        Column("invoice_id", LONG),
        Column("product_key", LONG),
        Column("qty", money(10)),
        Column("net_price", money(12)),
        Column("net_worth", money(12)),
        Column("vat_rate", money(5)),
        Column("gross_worth", money(12)),
        Column("created_at", STAMP),
    ),
    key="invoice_item_key",
    references=(Reference("product_key", "dim_product", "product_key"),),
    block_by="created_at",
    layout=PERIOD,
)

FACT_PAYMENT = Table(
    "fact_payment",
    (
        Column("payment_key", LONG, True),
        Column("invoice_id", LONG),
        Column("payment_date_key", INT),
        Column("amount", money(14)),
        Column("method", TEXT),
        Column("reference", TEXT),
        Column("created_at", STAMP),
    ),
    key="payment_key",
    references=(Reference("payment_date_key", "dim_date", "date_key"),),
    block_by="created_at",
    layout=PERIOD,
)


def _with_lineage(table: Table, source_id: str) -> Table:
    return replace(table, columns=(*table.columns, Column(source_id, LONG, True)), unique=(source_id,))


def star_tables(mode: str = "idempotent") -> dict[str, Table]:
    """The eight star tables.

    In `idempotent` mode the two appended facts also carry the source id of
    each row, so that a repeated read of the same row is recognised.
    """
    item, payment = FACT_INVOICE_ITEM, FACT_PAYMENT
    if mode == "idempotent":
        item, payment = _with_lineage(item, "item_id"), _with_lineage(payment, "payment_id")
    elif mode != "append":
        raise ValueError(f"unknown fact mode {mode!r}")
    tables = (MARKS, DIM_DATE, DIM_CLIENT, DIM_SELLER, DIM_PRODUCT, FACT_INVOICE, item, payment)
    return {t.name: t for t in tables}
