"""Declared rules as queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyfold.operators import quality
from tallyfold.operators.settle import settle
from tallyfold.plans import fixtures
from tallyfold.queries.reads import numbered_items
from tallyfold.queries.cycles import INVOICE_LOADS, ITEM_LOADS, table_after
from tallyfold.queries.registry import query, with_sources
from tallyfold.schemas import INVOICE_ITEMS, INVOICES, PAYMENTS, SOURCE_TABLES, star_tables


@query("unique_violations_product_name", "SELECT p_name, count(*) AS n FROM part GROUP BY 1 HAVING count(*) > 1")
def unique_names(spark, folder):
    return quality.unique_violations(fixtures.raw(spark, folder, "part"), ["p_name"])


@query(
    "unique_violations_line",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def unique_lines(spark, folder):
    return quality.unique_violations(fixtures.raw(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "unique_ignores_null",
    with_sources(
        "invoices",
        select="""
SELECT seller_id, count(*) AS n FROM invoices WHERE seller_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1""",
    ),
)
def unique_nulls(spark, folder):
    return quality.unique_violations(fixtures.invoices(spark, folder), ["seller_id"])


@query("null_violations", with_sources("invoices", select="SELECT * FROM invoices WHERE seller_id IS NULL"))
def nulls(spark, folder):
    required = [c.name for c in INVOICES.columns if c.required]
    return quality.null_violations(fixtures.invoices(spark, folder), required)


@query(
    "check_qty",
    """
SELECT l_orderkey, l_linenumber, CAST(l_quantity - 1 AS DECIMAL(10,2)) AS item_qty FROM lineitem
WHERE NOT (CAST(l_quantity - 1 AS DECIMAL(10,2)) > 0)""",
)
def check_qty(spark, folder):
    qty = (F.col("l_quantity") - 1).cast("decimal(10,2)").alias("item_qty")
    items = fixtures.raw(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", qty)
    return quality.check_violations(items, INVOICE_ITEMS.checks["item_qty_positive"])


@query(
    "check_amount",
    """
SELECT event_id, CAST(CAST(value AS DECIMAL(14,2)) - 1 AS DECIMAL(14,2)) AS amount FROM events
WHERE CAST(value AS DECIMAL(14,2)) - 1 <= 0""",
)
def check_amount(spark, folder):
    amount = (F.col("value").cast("decimal(14,2)") - 1).cast("decimal(14,2)").alias("amount")
    rows = fixtures.raw(spark, folder, "events").select("event_id", amount)
    return quality.check_violations(rows, PAYMENTS.checks["amount_positive"])


@query(
    "check_method",
    with_sources(
        "payments",
        select="""
SELECT payment_id, payment_method FROM (
  SELECT payment_id, CASE WHEN payment_method <> 'ONLINE' THEN payment_method END AS payment_method FROM payments)
WHERE payment_method NOT IN ('CASH', 'BANK_TRANSFER', 'CREDIT_CARD', 'CHECK', 'ONLINE')""",
    ),
)
def check_method(spark, folder):
    method = F.expr("CASE WHEN payment_method <> 'ONLINE' THEN payment_method END").alias("payment_method")
    rows = fixtures.payments(spark, folder).select("payment_id", method)
    return quality.check_violations(rows, PAYMENTS.checks["payment_method_known"])


@query(
    "length_violations",
    "SELECT p_partkey, p_name, p_type FROM part WHERE length(p_name) > 10 OR length(p_type) > 6",
)
def lengths(spark, folder):
    part = fixtures.raw(spark, folder, "part").select("p_partkey", "p_name", "p_type")
    return quality.length_violations(part, {"p_name": 10, "p_type": 6})


@query(
    "range_violations",
    """
SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(14,2)) AS price FROM orders
WHERE CAST(o_totalprice AS DECIMAL(14,2)) >= 100000""",
)
def ranges(spark, folder):
    price = F.col("o_totalprice").cast("decimal(14,2)").alias("price")
    return quality.range_violations(
        fixtures.raw(spark, folder, "orders").select("o_orderkey", price), {"price": "decimal(7,2)"}
    )


@query(
    "fk_violations",
    with_sources(
        "sellers",
        "invoices",
        select="""
SELECT invoice_id, seller_id FROM invoices i WHERE seller_id IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM sellers s WHERE s.seller_id = i.seller_id AND seller_address <> 'Nation 3')""",
    ),
)
def references(spark, folder):
    invoices = fixtures.invoices(spark, folder).select("invoice_id", "seller_id")
    sellers = fixtures.sellers(spark, folder).where("seller_address <> 'Nation 3'")
    return quality.fk_violations(invoices, "seller_id", sellers, "seller_id")


@query(
    "fk_violations_item",
    with_sources(
        "products",
        "invoice_items",
        select="""
SELECT item_id, product_id FROM invoice_items i WHERE NOT EXISTS (
  SELECT 1 FROM products p WHERE p.product_id = i.product_id AND unit_price <= 910)""",
    ),
)
def item_references(spark, folder):
    items = numbered_items(spark, folder).select("item_id", "product_id")
    products = fixtures.products(spark, folder).where("unit_price <= 910")
    return quality.fk_violations(items, "product_id", products, "product_id")


@query(
    "row_violations_payment",
    with_sources(
        "payments",
        select="""
SELECT payment_id, payment_method, amount, 'payment_method_known fails' AS breach
FROM payments WHERE payment_method = 'WIRE'""",
    ),
)
def payment_rules(spark, folder):
    found = quality.row_violations(PAYMENTS, fixtures.payments(spark, folder))
    return found.select("payment_id", "payment_method", "amount", "breach")


@query(
    "audit_source",
    with_sources(
        *SOURCE_TABLES,
        then="""
few AS (SELECT * FROM sellers WHERE seller_address <> 'Nation 3'),
twice AS (SELECT * FROM clients UNION ALL SELECT * FROM clients WHERE client_id % 10 = 0),
short AS (SELECT * REPLACE (item_qty - 1 AS item_qty) FROM invoice_items)""",
        select="""
SELECT 'invoices' AS table_name, 'seller_id is null' AS rule, CAST(invoice_id AS VARCHAR) AS value, 1 AS n
FROM invoices WHERE seller_id IS NULL
UNION ALL SELECT 'invoices', 'seller_id refers to no row', CAST(seller_id AS VARCHAR), count(*)
FROM invoices WHERE seller_id NOT IN (SELECT seller_id FROM few) GROUP BY seller_id
UNION ALL SELECT 'invoices', 'client_id refers to no row', CAST(client_id AS VARCHAR), count(*)
FROM invoices WHERE client_id NOT IN (SELECT client_id FROM clients) GROUP BY client_id
UNION ALL SELECT 'clients', 'client_id is repeated', CAST(client_id AS VARCHAR), count(*)
FROM twice GROUP BY client_id HAVING count(*) > 1
UNION ALL SELECT 'clients', 'client_tax_id is repeated', client_tax_id, count(*)
FROM twice GROUP BY client_tax_id HAVING count(*) > 1
UNION ALL SELECT 'invoice_items', 'item_qty_positive fails', CAST(item_id AS VARCHAR), 1 FROM short WHERE item_qty <= 0
UNION ALL SELECT 'invoice_items', 'invoice_id refers to no row', CAST(invoice_id AS VARCHAR), count(*)
FROM short WHERE invoice_id NOT IN (SELECT invoice_id FROM invoices) GROUP BY invoice_id
UNION ALL SELECT 'invoice_items', 'product_id refers to no row', CAST(product_id AS VARCHAR), count(*)
FROM short WHERE product_id NOT IN (SELECT product_id FROM products) GROUP BY product_id
UNION ALL SELECT 'payments', 'payment_method_known fails', CAST(payment_id AS VARCHAR), 1
FROM payments WHERE payment_method = 'WIRE'
UNION ALL SELECT 'payments', 'amount_positive fails', CAST(payment_id AS VARCHAR), 1 FROM payments WHERE amount <= 0
UNION ALL SELECT 'payments', 'invoice_id refers to no row', CAST(invoice_id AS VARCHAR), count(*)
FROM payments WHERE invoice_id NOT IN (SELECT invoice_id FROM invoices) GROUP BY invoice_id""",
    ),
)
def audit_source(spark, folder):
    """All rules of the six source tables: with a group of sellers left out, some clients twice and less of each item."""
    rows = {name: fixtures.READERS[name](spark, folder) for name in SOURCE_TABLES if name != "invoice_items"}
    rows["sellers"] = rows["sellers"].where("seller_address <> 'Nation 3'")
    rows["clients"] = rows["clients"].unionByName(rows["clients"].where("client_id % 10 = 0"))
    rows["invoice_items"] = numbered_items(spark, folder).withColumn("item_qty", F.col("item_qty") - 1)
    return quality.audit(SOURCE_TABLES, rows)


@query(
    "audit_star",
    with_sources(
        "sellers", "clients", "products", "invoices", "invoice_items",
        then=INVOICE_LOADS.replace("load1", "heads").replace("load2", "heads2") + "," + ITEM_LOADS,
        select="""
SELECT 'fact_invoice' AS table_name, 'seller_key refers to no row' AS rule, CAST(seller_key AS VARCHAR) AS value, count(*) AS n
FROM heads WHERE seller_key % 7 = 0 GROUP BY seller_key
UNION ALL SELECT 'fact_invoice', 'invoice_date_key refers to no row', strftime(invoice_date, '%Y%m%d'), count(*)
FROM heads WHERE day(invoice_date) = 13 GROUP BY invoice_date
UNION ALL SELECT 'fact_invoice_item', 'product_key refers to no row', CAST(product_key AS VARCHAR), count(*)
FROM load1 WHERE product_key % 50 = 0 GROUP BY product_key
UNION ALL SELECT 'dim_client', c || ' is repeated', CAST(v AS VARCHAR), 2
FROM (SELECT 'client_key' AS c, client_key AS v FROM dim_client1 WHERE client_id % 20 = 0
      UNION ALL SELECT 'client_id', client_id FROM dim_client1 WHERE client_id % 20 = 0) t""",
    ),
)
def audit_star(spark, folder):
    """All rules of the star after a cycle: with sellers, products and days left out and some clients twice."""
    names = ("dim_seller", "dim_client", "dim_product", "dim_date", "fact_invoice", "fact_invoice_item")
    rows = {name: table_after(spark, folder, name, 1) for name in names}
    rows["dim_seller"] = rows["dim_seller"].where("seller_key % 7 <> 0")
    rows["dim_product"] = rows["dim_product"].where("product_key % 50 <> 0")
    rows["dim_date"] = rows["dim_date"].where("date_key % 100 <> 13")
    rows["dim_client"] = rows["dim_client"].unionByName(rows["dim_client"].where("client_id % 20 = 0"))
    return quality.audit(star_tables(), rows)


@query(
    "settled_orders",
    """
SELECT o_orderkey, coalesce(
         first_value(o_orderstatus) OVER w = 'F' OR (count(*) OVER w > 1 AND coalesce(bool_or(o_orderstatus = 'P') OVER earlier, false)),
         false) AS stands
FROM orders
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING),
       earlier AS (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
)
def settled_orders(spark, folder):
    """An order stands if the customer's order before it stands or is in part delivered; the first, if it is delivered."""
    orders = fixtures.raw(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    before = F.lag("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    lines = orders.select(F.col("o_orderkey").cast("long").alias("line_no"), "o_orderstatus", before.cast("string").alias("before"))
    needs = lines.select(
        "line_no",
        F.when(F.col("before").isNull(), F.lit("status")).otherwise(F.lit("order")).alias("kind"),
        F.coalesce("before", "o_orderstatus", F.lit("none")).alias("name"),
    )
    order = (F.lit("order").alias("kind"), F.col("line_no").cast("string").alias("name"))
    partly = lines.where("o_orderstatus = 'P'").select(*order, F.col("line_no").alias("first"))
    delivered = spark.range(1).select(F.lit("status").alias("kind"), F.lit("F").alias("name"), F.lit(-1).cast("long").alias("first"))
    verdicts, _ = settle(needs, lines.select("line_no", *order), partly.unionByName(delivered))
    return verdicts.withColumnRenamed("line_no", "o_orderkey")
