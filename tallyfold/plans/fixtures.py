"""The six source tables derived from order, customer, part and event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions.calendar import stamp
from tallyfold.functions.numbers import gross_worth
from tallyfold.operators.keys import assign_keys_by_range
from tallyfold.schemas import SOURCE_TABLES

CREATED = "2024-01-01 00:00:00"


def raw(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _days_after(column: str):
    """The first of 2024 plus a number of days."""
    return F.date_add(F.lit("2024-01-01").cast("date"), F.col(column).cast("int")).cast("timestamp_ntz")


def _shape(df: DataFrame, table: str) -> DataFrame:
    return df.select(*(F.col(c.name).cast(c.type).alias(c.name) for c in SOURCE_TABLES[table].columns))


def clients(spark: SparkSession, folder: str) -> DataFrame:
    df = raw(spark, folder, "customer").select(
        F.col("c_custkey").alias("client_id"),
        F.col("c_name").alias("client_name"),
        F.col("c_mktsegment").alias("client_address"),
        F.concat(F.lit("TAX-C-"), "c_custkey").alias("client_tax_id"),
        F.lit(None).alias("iban"),
        stamp(CREATED).alias("created_at"),
        _days_after("c_nationkey").alias("updated_at"),
    )
    return _shape(df, "clients")


def sellers(spark: SparkSession, folder: str) -> DataFrame:
    df = raw(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("seller_id"),
        F.col("s_name").alias("seller_name"),
        F.concat(F.lit("Nation "), "s_nationkey").alias("seller_address"),
        F.concat(F.lit("TAX-S-"), "s_suppkey").alias("seller_tax_id"),
        F.concat(F.lit("IB-"), "s_suppkey").alias("iban"),
        stamp(CREATED).alias("created_at"),
        _days_after("s_nationkey").alias("updated_at"),
    )
    return _shape(df, "sellers")


def products(spark: SparkSession, folder: str) -> DataFrame:
    df = raw(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("product_description"),
        F.col("p_retailprice").alias("unit_price"),
        F.lit("10.00").alias("vat_rate"),
        stamp(CREATED).alias("created_at"),
        _days_after("p_size").alias("updated_at"),
    )
    return _shape(df, "products")


# Invoice status by order status, payment method by event type.
STATUS = {"O": "UNPAID", "P": "PARTIALLY_PAID", "F": "PAID"}
METHOD = {
    "click": "CASH",
    "purchase": "BANK_TRANSFER",
    "signup": "CREDIT_CARD",
    "view": "ONLINE",
    "error": "WIRE",
}


def _mapped(column: str, values: dict[str, str]):
    pairs = [F.lit(text) for pair in values.items() for text in pair]
    return F.element_at(F.create_map(*pairs), F.col(column))


def invoices(spark: SparkSession, folder: str) -> DataFrame:
    """Orders; the seller is the least supplier of the order's lines, if it has any."""
    first_supplier = (
        raw(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.min("l_suppkey").alias("seller_id"))
    )
    net = F.col("o_totalprice").cast("decimal(14,2)")
    vat = (net * F.lit("0.10").cast("decimal(3,2)")).cast("decimal(14,2)")
    df = (
        raw(spark, folder, "orders")
        .join(first_supplier, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            F.col("o_orderkey").alias("invoice_id"),
            F.concat(F.lit("INV-"), "o_orderkey").alias("invoice_no"),
            F.col("o_orderdate").alias("invoice_date"),
            "seller_id",
            F.col("o_custkey").alias("client_id"),
            net.alias("total_net_worth"),
            vat.alias("total_vat"),
            (net + vat).alias("total_gross_worth"),
            _mapped("o_orderstatus", STATUS).alias("status"),
            F.col("o_orderdate").alias("created_at"),
            F.col("o_orderdate").alias("updated_at"),
        )
    )
    return _shape(df, "invoices")


LINE_ORDER = [
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
]


def invoice_items(spark: SparkSession, folder: str, numbered: bool = True) -> DataFrame:
    """Order lines. With `numbered` the item id is the rank over all columns, else NULL."""
    lines = raw(spark, folder, "lineitem")
    if numbered:
        lines, _ = assign_keys_by_range(lines, LINE_ORDER, 0, "item_id")
    else:
        lines = lines.withColumn("item_id", F.lit(None))
    qty = F.col("l_quantity").cast("decimal(10,2)")
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    vat = (F.col("l_tax").cast("decimal(5,2)") * F.lit(100)).cast("decimal(5,2)")
    net = qty * price
    df = lines.select(
        "item_id",
        F.col("l_orderkey").alias("invoice_id"),
        F.col("l_partkey").alias("product_id"),
        qty.alias("item_qty"),
        price.alias("item_net_price"),
        net.alias("item_net_worth"),
        vat.alias("item_vat_rate"),
        gross_worth(net, vat).alias("item_gross_worth"),
        F.col("l_shipdate").alias("created_at"),
    )
    return _shape(df, "invoice_items")


def payments(spark: SparkSession, folder: str) -> DataFrame:
    """Events; four consecutive events pay one invoice."""
    amount = F.col("value").cast("decimal(14,2)") * F.lit(1000)
    df = raw(spark, folder, "events").select(
        F.col("event_id").alias("payment_id"),
        F.expr("event_id div 4").alias("invoice_id"),
        F.col("ts").alias("payment_date"),
        _mapped("event_type", METHOD).alias("payment_method"),
        F.concat(F.lit("EV-"), "event_id").alias("payment_reference"),
        amount.alias("amount"),
        F.lit(None).alias("remarks"),
        F.col("ts").alias("created_at"),
    )
    return _shape(df, "payments")


READERS = {
    "clients": clients,
    "sellers": sellers,
    "products": products,
    "invoices": invoices,
    "invoice_items": invoice_items,
    "payments": payments,
}


def source(spark: SparkSession, folder: str):
    """All six streams as a function of the table name."""
    return lambda table: READERS[table](spark, folder)
