"""Projections and key lookups between source rows and star rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.calendar import calendar_columns, date_key


def _project_party(df: DataFrame, singular: str) -> DataFrame:
    return df.select(
        f"{singular}_id",
        f"{singular}_name",
        F.col(f"{singular}_address").alias(f"{singular}_addr"),
        f"{singular}_tax_id",
        "iban",
        "updated_at",
    )


def project_client(df: DataFrame) -> DataFrame:
    return _project_party(df, "client")


def project_seller(df: DataFrame) -> DataFrame:
    return _project_party(df, "seller")


def project_product(df: DataFrame) -> DataFrame:
    description = F.col("product_description").alias("product_desc")
    return df.select("product_id", "product_name", description, "unit_price", "vat_rate", "updated_at")


def project_invoice(df: DataFrame) -> DataFrame:
    """Resolved invoices with the columns of the fact, except its surrogate key."""
    return df.select(
        "invoice_id",
        "invoice_no",
        date_key(F.col("invoice_date")).alias("invoice_date_key"),
        "seller_key",
        "client_key",
        F.col("total_net_worth").alias("total_net"),
        "total_vat",
        F.col("total_gross_worth").alias("total_gross"),
        "status",
        "updated_at",
    )


def project_item(df: DataFrame, lineage: bool = True) -> DataFrame:
    columns = [
        "invoice_id",
        "product_key",
        F.col("item_qty").alias("qty"),
        F.col("item_net_price").alias("net_price"),
        F.col("item_net_worth").alias("net_worth"),
        F.col("item_vat_rate").alias("vat_rate"),
        F.col("item_gross_worth").alias("gross_worth"),
        "created_at",
    ]
    return df.select(*columns, *(["item_id"] if lineage else []))


def project_payment(df: DataFrame, lineage: bool = True) -> DataFrame:
    columns = [
        "invoice_id",
        date_key(F.col("payment_date")).alias("payment_date_key"),
        "amount",
        F.col("payment_method").alias("method"),
        F.col("payment_reference").alias("reference"),
        "created_at",
    ]
    return df.select(*columns, *(["payment_id"] if lineage else []))


# Only id and key of a dimension are joined, no hint is given: the planner
# broadcasts that pair of columns while it is small by measured size and
# shuffles beyond, where adaptive execution splits an id that most rows share.


def resolve_invoice_keys(invoices: DataFrame, dim_seller: DataFrame, dim_client: DataFrame) -> DataFrame:
    """Add seller and client keys; invoices without either are left out."""
    sellers = dim_seller.select("seller_id", "seller_key")
    clients = dim_client.select("client_id", "client_key")
    return invoices.join(sellers, "seller_id").join(clients, "client_id")


def resolve_item_keys(items: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Add the product key; items of unknown products are left out."""
    return items.join(dim_product.select("product_id", "product_key"), "product_id")


def unresolved_invoices(invoices: DataFrame, dim_seller: DataFrame, dim_client: DataFrame) -> DataFrame:
    """Invoices that `resolve_invoice_keys` leaves out, and which party is unknown."""
    sellers = dim_seller.select("seller_id", F.lit(True).alias("_seller"))
    clients = dim_client.select("client_id", F.lit(True).alias("_client"))
    return (
        invoices.join(sellers, "seller_id", "left")
        .join(clients, "client_id", "left")
        .where(F.col("_seller").isNull() | F.col("_client").isNull())
        .select(
            *invoices.columns,
            F.col("_seller").isNull().alias("seller_missing"),
            F.col("_client").isNull().alias("client_missing"),
        )
    )


def unresolved_items(items: DataFrame, dim_product: DataFrame) -> DataFrame:
    return items.join(dim_product.select("product_id"), "product_id", "left_anti").select(*items.columns)


def missing_dates(dim_date: DataFrame, dates: DataFrame) -> DataFrame:
    """Date rows to add for a one-column frame of dates; NULL dates have none.

    `distinct` keeps one row per date in each task before the shuffle, so its
    cost follows the calendar, not the facts.
    """
    column = dates.columns[0]
    wanted = dates.where(F.col(column).isNotNull()).distinct()
    return (
        wanted.select(*calendar_columns(F.col(column)))
        .join(dim_date.select("date_key"), "date_key", "left_anti")
        .select("date_key", *(c for c in dim_date.columns if c != "date_key"))
    )
