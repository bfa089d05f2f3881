"""Read queries, scalar functions and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.functions import calendar, numbers, status
from tallyfold.operators import reads, star
from tallyfold.operators.incremental import changed_since, incremental, seed_marks
from tallyfold.operators.merge import first_per_key, lookup_ids
from tallyfold.plans import fixtures
from tallyfold.queries.registry import once, query, with_sources

ALL = ("clients", "sellers", "products", "invoices", "invoice_items", "payments")

# One row per item and payment of its invoice: what was bought, from whom, and how it was paid.
DETAIL = """
SELECT invoice_no, invoice_date, seller_name, client_name, product_name, item_qty, item_net_price, item_gross_worth,
       payments.amount AS payment_amount, payment_method, payment_date
FROM invoice_items
JOIN products USING (product_id)
JOIN invoices USING (invoice_id)
JOIN sellers USING (seller_id)
JOIN clients USING (client_id)
LEFT JOIN payments USING (invoice_id)
"""


def tables(spark, folder):
    """Source tables; items without ids, which no read query needs."""

    def table(name):
        if name == "invoice_items":
            return fixtures.invoice_items(spark, folder, numbered=False)
        return fixtures.READERS[name](spark, folder)

    return table


def numbered_items(spark, folder):
    return once(spark, "items", folder, lambda: fixtures.invoice_items(spark, folder))


@query("invoice_detail", with_sources(*ALL, select=DETAIL))
def invoice_detail(spark, folder):
    return reads.invoice_detail(tables(spark, folder))


@query("invoice_point", with_sources(*ALL, select=DETAIL + "WHERE invoice_no = 'INV-42'"))
def invoice_point(spark, folder):
    return reads.invoice_detail(tables(spark, folder), "INV-42")


@query(
    "derive_status",
    with_sources(
        "invoices",
        "payments",
        select="""
SELECT i.invoice_id, i.invoice_no, i.total_gross_worth,
       CASE WHEN paid IS NULL THEN 'UNPAID' WHEN paid >= total_gross_worth THEN 'PAID' ELSE 'PARTIALLY_PAID' END AS status
FROM invoices i LEFT JOIN (SELECT invoice_id, sum(amount) AS paid FROM payments GROUP BY invoice_id) p
  ON p.invoice_id = i.invoice_id""",
    ),
)
def derive_status(spark, folder):
    t = tables(spark, folder)
    found = reads.derive_status(t("invoices"), t("payments"))
    return found.select("invoice_id", "invoice_no", "total_gross_worth", "status")


@query("recent_clients", with_sources("clients", select="SELECT * FROM clients ORDER BY updated_at DESC, client_id"))
def recent_clients(spark, folder):
    return reads.recent(fixtures.clients(spark, folder), "updated_at", "client_id")


@query("peek_invoices", "SELECT least(5, count(*)) AS n FROM orders")
def peek_invoices(spark, folder):
    return reads.peek(fixtures.invoices(spark, folder), 5).agg(F.count("*").alias("n"))


@query(
    "calendar",
    """
SELECT DISTINCT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INT) AS date_key, d AS "date",
       CAST(year(d) AS INT) AS year, CAST(quarter(d) AS INT) AS quarter, CAST(month(d) AS INT) AS month,
       strftime(d, '%b') AS month_name, CAST(day(d) AS INT) AS day, CAST(dayofweek(d) + 1 AS INT) AS day_of_week,
       strftime(d, '%a') AS day_name, CAST(week(d) AS INT) AS week_of_year
FROM (SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem)""",
)
def calendar_rows(spark, folder):
    dates = fixtures.raw(spark, folder, "lineitem").select(F.col("l_shipdate").cast("date").alias("d"))
    empty = spark.createDataFrame([], star_schema("dim_date"))
    return star.missing_dates(empty, dates)


def star_schema(name):
    from tallyfold.schemas import star_tables

    return star_tables()[name].schema


@query(
    "money_parse",
    """
SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(14,2)) AS summary_amount,
       CAST(o_totalprice AS DECIMAL(18,8)) AS item_number, CAST(8 AS DECIMAL(9,6)) AS vat_given,
       CAST(10 AS DECIMAL(9,6)) AS vat_absent, CAST(NULL AS DECIMAL(18,8)) AS bad_number,
       CAST(round(o_totalprice * 100) / 100000 AS DECIMAL(14,6)) AS comma_point
FROM orders""",
)
def money_parse(spark, folder):
    price = F.col("o_totalprice").cast("decimal(14,2)")
    grouped = F.format_number(price, 2)
    vat = F.lit("8 %")
    return fixtures.raw(spark, folder, "orders").select(
        "o_orderkey",
        numbers.summary_amount(F.concat(F.lit("$ "), grouped)).alias("summary_amount"),
        numbers.item_number(F.replace(price.cast("string"), F.lit("."), F.lit(","))).alias("item_number"),
        numbers.vat_rate(vat, vat.isNotNull()).alias("vat_given"),
        numbers.vat_rate(F.lit(None).cast("string"), F.lit(False)).alias("vat_absent"),
        # Two points in one number.
        numbers.item_number(F.concat(F.lit("1,"), price.cast("string"))).alias("bad_number"),
        # The optional reading of a summary comma as the decimal point.
        numbers.to_decimal(
            numbers.summary_text(
                F.replace((price / F.lit(1000)).cast("decimal(14,6)").cast("string"), F.lit("."), F.lit(",")), True
            ),
            "decimal(14,6)",
        ).alias("comma_point"),
    )


@query(
    "date_parse",
    """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS short, CAST(o_orderdate AS DATE) AS padded,
       CAST(NULL AS DATE) AS other_order
FROM orders""",
)
def date_parse(spark, folder):
    day = F.col("o_orderdate")
    return fixtures.raw(spark, folder, "orders").select(
        "o_orderkey",
        calendar.parse_us_date(F.date_format(day, "M/d/yyyy")).alias("short"),
        calendar.parse_us_date(F.date_format(day, "MM/dd/yyyy")).alias("padded"),
        calendar.parse_us_date(F.date_format(day, "yyyy/MM/dd")).alias("other_order"),
    )


@query(
    "item_worths",
    """
SELECT l_orderkey, l_linenumber, item_qty, item_net_price,
       CAST(item_qty * item_net_price AS DECIMAL(12,2)) AS item_net_worth, item_vat_rate,
       CAST(item_qty * item_net_price + (item_qty * item_net_price) * item_vat_rate * 0.01 AS DECIMAL(12,2))
         AS item_gross_worth
FROM (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DECIMAL(10,2)) AS item_qty,
             CAST(l_extendedprice AS DECIMAL(12,2)) AS item_net_price,
             CAST(CAST(l_tax AS DECIMAL(5,2)) * 100 AS DECIMAL(5,2)) AS item_vat_rate FROM lineitem)""",
)
def item_worths(spark, folder):
    none = F.lit(None).cast("decimal(12,2)")
    items = fixtures.raw(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").cast("decimal(10,2)").alias("item_qty"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("item_net_price"),
        none.alias("item_net_worth"),
        (F.col("l_tax").cast("decimal(5,2)") * 100).cast("decimal(5,2)").alias("item_vat_rate"),
        none.alias("item_gross_worth"),
    )
    return reads.with_worths(items)


@query(
    "rounding",
    """
SELECT l_orderkey, l_linenumber, l_partkey,
       CAST(CASE WHEN abs(thousandths) % 10 = 5 AND (abs(thousandths) // 10) % 2 = 0
            THEN (thousandths - sign(thousandths) * 5) / 1000.0
            ELSE CAST(thousandths * 0.001 AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS half_even,
       CAST(thousandths * 0.001 AS DECIMAL(12,2)) AS half_up
FROM (SELECT *, CAST(l_quantity AS BIGINT) * CAST(l_partkey - 1000 AS BIGINT) AS thousandths FROM lineitem)""",
)
def rounding(spark, folder):
    value = (F.col("l_quantity").cast("long") * (F.col("l_partkey") - 1000)).cast("decimal(14,0)")
    value = value * F.lit("0.001").cast("decimal(4,3)")
    return fixtures.raw(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        numbers.round_half_even(value).cast("decimal(18,2)").alias("half_even"),
        numbers.store_money(value, 12).alias("half_up"),
    )


@query(
    "payment_due",
    """
SELECT o_orderkey, CAST(o_orderdate AS DATE) + 30 AS due, 'TXN-INV-' || o_orderkey || '-' || (o_custkey + 100) AS reference,
       CASE WHEN CAST(o_totalprice AS DECIMAL(14,2)) >= 250000 THEN 'PAID' ELSE 'PARTIALLY_PAID' END AS status
FROM orders""",
)
def payment_due(spark, folder):
    price = F.col("o_totalprice").cast("decimal(14,2)")
    return fixtures.raw(spark, folder, "orders").select(
        "o_orderkey",
        calendar.payment_due(F.col("o_orderdate").cast("date"), 30).alias("due"),
        status.payment_reference(F.concat(F.lit("INV-"), "o_orderkey"), F.col("o_custkey") + 100).alias("reference"),
        status.payment_status(price, F.lit(250000)).alias("status"),
    )


@query(
    "changed_clients",
    with_sources("clients", select="SELECT * FROM clients WHERE updated_at >= TIMESTAMP '2024-01-15'"),
)
def changed_clients(spark, folder):
    return changed_since(fixtures.clients(spark, folder), "updated_at", "2024-01-15 00:00:00")


@query(
    "changed_payments",
    with_sources("payments", select="SELECT * FROM payments WHERE created_at >= TIMESTAMP '2024-01-15 12:00:00'"),
)
def changed_payments(spark, folder):
    marks = seed_marks(spark).withColumn("last_loaded_ts", calendar.stamp("2024-01-15 12:00:00"))
    return incremental(fixtures.payments(spark, folder), marks, "payments", "created_at")


@query("missing_mark_loads_nothing", with_sources("clients", select="SELECT * FROM clients WHERE false"))
def missing_mark_loads_nothing(spark, folder):
    marks = seed_marks(spark).where("stream_name <> 'clients'")
    return incremental(fixtures.clients(spark, folder), marks, "clients", "updated_at")


PROJECTED = {
    "client": "client_id, client_name, client_address AS client_addr, client_tax_id, iban, updated_at",
    "seller": "seller_id, seller_name, seller_address AS seller_addr, seller_tax_id, iban, updated_at",
    "product": "product_id, product_name, product_description AS product_desc, unit_price, vat_rate, updated_at",
}


@query("project_client", with_sources("clients", select=f"SELECT {PROJECTED['client']} FROM clients"))
def project_client(spark, folder):
    return star.project_client(fixtures.clients(spark, folder))


@query("project_seller", with_sources("sellers", select=f"SELECT {PROJECTED['seller']} FROM sellers"))
def project_seller(spark, folder):
    return star.project_seller(fixtures.sellers(spark, folder))


@query("project_product", with_sources("products", select=f"SELECT {PROJECTED['product']} FROM products"))
def project_product(spark, folder):
    return star.project_product(fixtures.products(spark, folder))


@query(
    "project_payment",
    with_sources(
        "payments",
        select="""
SELECT invoice_id, CAST(strftime(payment_date, '%Y%m%d') AS INT) AS payment_date_key, amount,
       payment_method AS method, payment_reference AS reference, created_at
FROM payments""",
    ),
)
def project_payment(spark, folder):
    return star.project_payment(fixtures.payments(spark, folder), lineage=False)


# Dimension rows with keys that differ from the ids; some parties and products are unknown.
KNOWN_SELLERS = "seller_address <> 'Nation 3'"
KNOWN_PRODUCTS = "product_description <> 'PROMO'"


def dimension(df, singular):
    return df.withColumn(f"{singular}_key", F.col(f"{singular}_id") * 3 + 7)


@query(
    "resolve_invoice",
    with_sources(
        "clients",
        "sellers",
        "invoices",
        select=f"""
SELECT i.invoice_id, i.invoice_no, CAST(strftime(i.invoice_date, '%Y%m%d') AS INT) AS invoice_date_key,
       s.seller_id * 3 + 7 AS seller_key, c.client_id * 3 + 7 AS client_key, i.total_net_worth AS total_net,
       i.total_vat, i.total_gross_worth AS total_gross, i.status, i.updated_at
FROM invoices i JOIN sellers s ON s.seller_id = i.seller_id JOIN clients c ON c.client_id = i.client_id
WHERE {KNOWN_SELLERS}""",
    ),
)
def resolve_invoice(spark, folder):
    t = tables(spark, folder)
    sellers = dimension(t("sellers").where(KNOWN_SELLERS), "seller")
    return star.project_invoice(star.resolve_invoice_keys(t("invoices"), sellers, dimension(t("clients"), "client")))


@query(
    "unresolved_invoices",
    with_sources(
        "clients",
        "sellers",
        "invoices",
        select=f"""
SELECT i.invoice_id, i.seller_id, i.client_id, s.seller_id IS NULL AS seller_missing, c.client_id IS NULL AS client_missing
FROM invoices i LEFT JOIN (SELECT * FROM sellers WHERE {KNOWN_SELLERS}) s ON s.seller_id = i.seller_id
LEFT JOIN (SELECT * FROM clients WHERE client_address <> 'MACHINERY') c ON c.client_id = i.client_id
WHERE s.seller_id IS NULL OR c.client_id IS NULL""",
    ),
)
def unresolved_invoices(spark, folder):
    t = tables(spark, folder)
    sellers, clients = t("sellers").where(KNOWN_SELLERS), t("clients").where("client_address <> 'MACHINERY'")
    found = star.unresolved_invoices(t("invoices"), sellers, clients)
    return found.select("invoice_id", "seller_id", "client_id", "seller_missing", "client_missing")


@query(
    "resolve_item",
    with_sources(
        "products",
        "invoice_items",
        select=f"""
SELECT ii.item_id, ii.invoice_id, p.product_id * 3 + 7 AS product_key, item_qty AS qty, item_net_price AS net_price,
       item_net_worth AS net_worth, item_vat_rate AS vat_rate, item_gross_worth AS gross_worth, ii.created_at
FROM invoice_items ii JOIN products p ON p.product_id = ii.product_id WHERE {KNOWN_PRODUCTS}""",
    ),
)
def resolve_item(spark, folder):
    products = dimension(fixtures.products(spark, folder).where(KNOWN_PRODUCTS), "product")
    return star.project_item(star.resolve_item_keys(numbered_items(spark, folder), products))


@query(
    "unresolved_items",
    with_sources(
        "products",
        "invoice_items",
        select=f"""
SELECT ii.* FROM invoice_items ii
WHERE NOT EXISTS (SELECT 1 FROM products p WHERE p.product_id = ii.product_id AND {KNOWN_PRODUCTS})""",
    ),
)
def unresolved_items(spark, folder):
    products = fixtures.products(spark, folder).where(KNOWN_PRODUCTS)
    return star.unresolved_items(numbered_items(spark, folder), products)


@query(
    "lookup_ids",
    """
SELECT p.p_partkey, p.p_name, f.id AS product_id FROM part p
LEFT JOIN (SELECT p_name, min(p_partkey) AS id FROM part WHERE p_type <> 'PROMO' GROUP BY p_name) f USING (p_name)""",
)
def lookup(spark, folder):
    part = fixtures.raw(spark, folder, "part")
    known = first_per_key(part.where("p_type <> 'PROMO'").select("p_name", "p_partkey"), "p_name", F.col("p_partkey"))
    ids = known.withColumnRenamed("p_partkey", "product_id")
    return lookup_ids(part.select("p_partkey", "p_name"), ids, "p_name", "product_id")


@query(
    "first_per_key",
    """
SELECT p_name, p_partkey, p_brand, p_type, p_size, p_retailprice FROM (
  SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_retailprice DESC, p_partkey) AS r FROM part) WHERE r = 1""",
)
def first_rows(spark, folder):
    part = fixtures.raw(spark, folder, "part")
    return first_per_key(part, "p_name", F.struct(-F.col("p_retailprice"), F.col("p_partkey")))
