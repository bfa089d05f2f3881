"""Read queries on the source model and the star."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.numbers import gross_worth, net_worth, store_money
from tallyfold.functions.status import payment_status
from tallyfold.sources.store import TableStore

# Invoice numbers are unique, so a point read finds one id; more than this
# many ids (a broken table) are joined instead of listed in the filter.
LISTED_IDS = 1000


def invoice_detail(tables: TableStore | Callable[[str], DataFrame], invoice_no: str | None = None) -> DataFrame:
    """Invoices with parties, items, products and payments, one row per item
    and payment. `tables` is a store, or gives a DataFrame by table name.

    For one invoice its id is looked up first and goes into the scans of items
    and payments as a literal, where Parquet statistics skip all other
    row groups. In a store the id comes from the index of invoice numbers, and
    only the blocks of this invoice are opened.
    """
    if isinstance(tables, TableStore):
        tables = _of_invoice(tables, invoice_no) if invoice_no is not None else tables.read
    invoices, items, payments = tables("invoices"), tables("invoice_items"), tables("payments")
    if invoice_no is not None:
        invoices = invoices.where(F.col("invoice_no") == invoice_no)
        ids = [r[0] for r in invoices.select("invoice_id").limit(LISTED_IDS + 1).collect()]
        if len(ids) <= LISTED_IDS:
            items = items.where(F.col("invoice_id").isin(ids))
            payments = payments.where(F.col("invoice_id").isin(ids))
    paid = payments.select("invoice_id", F.col("amount").alias("payment_amount"), "payment_method", "payment_date")
    return (
        invoices.join(tables("sellers").select("seller_id", "seller_name"), "seller_id")
        .join(tables("clients").select("client_id", "client_name"), "client_id")
        .join(items.select("invoice_id", "product_id", "item_qty", "item_net_price", "item_gross_worth"), "invoice_id")
        .join(tables("products").select("product_id", "product_name"), "product_id")
        .join(paid, "invoice_id", "left")
        .select(
            "invoice_no",
            "invoice_date",
            "seller_name",
            "client_name",
            "product_name",
            "item_qty",
            "item_net_price",
            "item_gross_worth",
            "payment_amount",
            "payment_method",
            "payment_date",
        )
    )


def _of_invoice(store: TableStore, invoice_no: str) -> Callable[[str], DataFrame]:
    """Tables of a store, invoices and their children narrowed to the blocks of one invoice."""
    tx = store.begin()
    number = store.spark.createDataFrame([(invoice_no,)], "invoice_no string")
    ids = tx.ids_of("invoices", number).where(F.col("invoice_no") == invoice_no).select("invoice_id")
    ids = store.spark.createDataFrame(ids.limit(LISTED_IDS + 1).collect(), ids.schema)
    narrow = ("invoices", "invoice_items", "payments")
    return lambda name: tx.read(name, tx.blocks_of(name, ids, "invoice_id") if name in narrow else None)


def derive_status(invoices: DataFrame, payments: DataFrame) -> DataFrame:
    """Invoices with the status that the sum of their payments gives."""
    paid = payments.groupBy("invoice_id").agg(F.sum("amount").alias("_paid"))
    status = payment_status(F.col("_paid"), F.col("total_gross_worth"))
    return invoices.join(paid, "invoice_id", "left").withColumn("status", status).select(*invoices.columns)


def with_worths(items: DataFrame) -> DataFrame:
    """Items with net and gross worth computed where they are NULL."""
    net = net_worth(F.col("item_qty"), F.col("item_net_price"))
    gross = gross_worth(net, F.col("item_vat_rate"))
    return items.withColumns(
        {
            "item_net_worth": F.coalesce("item_net_worth", store_money(net, 12)),
            "item_gross_worth": F.coalesce("item_gross_worth", store_money(gross, 12)),
        }
    )


def recent(df: DataFrame, column: str = "updated_at", *then: str) -> DataFrame:
    """Newest first; rows without a stamp come before all others."""
    return df.orderBy(F.desc_nulls_first(column), *then)


def peek(df: DataFrame, n: int) -> DataFrame:
    """Any n rows."""
    return df.limit(n)


def verify_star(store, sample: int = 5) -> tuple[DataFrame, DataFrame]:
    """Clients, newest first, and a few invoices of the star."""
    return recent(store.read("dim_client")), peek(store.read("fact_invoice"), sample)
