"""Merges, key numbering, update and delete as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.operators import dml, quality, reads
from tallyfold.operators.keys import assign_keys, assign_keys_by_range
from tallyfold.operators.merge import get_or_create, insert_ignore, latest_per_key, upsert_frame
from tallyfold.plans import fixtures
from tallyfold.plans.ingest import open_source
from tallyfold.queries.reads import DETAIL, numbered_items
from tallyfold.queries.registry import SQL, once, query, with_sources
from tallyfold.schemas import INVOICES, SOURCE_TABLES
from tallyfold.session import fresh_path

NOW = "2024-05-01 10:00:00"


@query(
    "upsert_frozen_column",
    with_sources(
        "products",
        select="""
SELECT product_id,
       CASE WHEN unit_price > 910 THEN product_name || ' new' ELSE product_name END AS product_name,
       CASE WHEN product_description = 'PROMO' AND unit_price > 910 THEN 'PROMO new' ELSE product_description END
         AS product_description,
       CASE WHEN unit_price > 910 THEN NULL ELSE unit_price END AS unit_price
FROM products
WHERE product_description <> 'PROMO' OR unit_price > 910""",
    ),
)
def upsert_frozen(spark, folder):
    """Known products lose their price and keep their description; PROMO products are new."""
    rows = fixtures.products(spark, folder).select("product_id", "product_name", "product_description", "unit_price")
    target = rows.where("product_description <> 'PROMO'")
    batch = rows.where("unit_price > 910").select(
        "product_id",
        F.concat("product_name", F.lit(" new")).alias("product_name"),
        F.concat("product_description", F.lit(" new")).alias("product_description"),
        F.lit(None).cast("decimal(12,2)").alias("unit_price"),
    )
    return upsert_frame(target, batch, "product_id", ("product_name", "unit_price"))


@query(
    "insert_ignore",
    """
WITH target AS (SELECT p_name FROM part WHERE p_size > 48),
batch AS (SELECT p_name, min(p_partkey) AS p_partkey FROM part GROUP BY p_name)
SELECT * FROM batch WHERE p_name NOT IN (SELECT p_name FROM target)""",
)
def insert_new(spark, folder):
    part = fixtures.raw(spark, folder, "part").select("p_name", "p_partkey", "p_size")
    target = part.where("p_size > 48")
    return insert_ignore(target, part.select("p_name", "p_partkey"), "p_name", F.col("p_partkey"))


@query(
    "get_or_create_product",
    """
WITH existing AS (SELECT DISTINCT p_name FROM part WHERE p_size > 49),
firsts AS (
  SELECT p_name, p_partkey, p_type, CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price,
         row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS r
  FROM part WHERE p_name NOT IN (SELECT p_name FROM existing))
SELECT p_name, p_partkey, p_type, unit_price, 500 + row_number() OVER (ORDER BY p_partkey) AS product_id
FROM firsts WHERE r = 1""",
)
def create_products(spark, folder):
    part = fixtures.raw(spark, folder, "part")
    price = F.col("p_retailprice").cast("decimal(12,2)").alias("unit_price")
    candidates = part.select("p_name", "p_partkey", "p_type", price)
    new, _ = get_or_create(part.where("p_size > 49"), candidates, "p_name", "p_partkey", "product_id", 500)
    return new


@query(
    "latest_per_key",
    """
SELECT o_custkey, o_orderkey, o_orderdate FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders)
WHERE r = 1""",
)
def latest(spark, folder):
    orders = fixtures.raw(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return latest_per_key(orders, "o_custkey", "o_orderdate")


@query("surrogate_keys", "SELECT o_orderkey, 100 + row_number() OVER (ORDER BY o_orderkey) AS invoice_key FROM orders")
def keys(spark, folder):
    orders = fixtures.raw(spark, folder, "orders").select("o_orderkey")
    return assign_keys(orders, "o_orderkey", 100, "invoice_key")[0]


@query(
    "surrogate_keys_any_order",
    """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderstatus, o_orderpriority, o_orderkey) AS n FROM orders""",
)
def keys_by_range(spark, folder):
    orders = fixtures.raw(spark, folder, "orders").select("o_orderstatus", "o_orderpriority", "o_orderkey")
    numbered, _ = assign_keys_by_range(orders, ["o_orderstatus", "o_orderpriority", "o_orderkey"], 0, "n")
    return numbered.select("o_orderkey", "n")


@query(
    "defaults",
    f"""
SELECT o_orderkey AS invoice_id, 'INV-' || o_orderkey AS invoice_no, CAST(o_orderdate AS DATE) AS invoice_date,
       CAST(NULL AS DECIMAL(14,2)) AS total_vat, CAST(0 AS DECIMAL(14,2)) AS total_net_worth,
       CAST(0 AS DECIMAL(14,2)) AS total_gross_worth, 'UNPAID' AS status, CAST(NULL AS BIGINT) AS seller_id,
       CAST(NULL AS BIGINT) AS client_id, TIMESTAMP '{NOW}' AS created_at, TIMESTAMP '{NOW}' AS updated_at
FROM orders""",
)
def defaults(spark, folder):
    given = fixtures.invoices(spark, folder).select(
        "invoice_id", "invoice_no", "invoice_date", F.lit(None).cast("decimal(14,2)").alias("total_vat")
    )
    return dml.with_defaults(given, INVOICES, NOW)


@query(
    "update_where_touch",
    with_sources(
        "products",
        select=f"""
SELECT product_id, product_name, product_description, vat_rate, created_at,
       CASE WHEN product_name = 'red widget' THEN CAST(1550.00 AS DECIMAL(12,2)) ELSE unit_price END AS unit_price,
       CASE WHEN product_name = 'red widget' THEN TIMESTAMP '{NOW}' ELSE updated_at END AS updated_at
FROM products""",
    ),
)
def update_touch(spark, folder):
    price = {"unit_price": F.lit("1550.00")}
    return dml.update_where(fixtures.products(spark, folder), F.col("product_name") == "red widget", price, NOW)


@query(
    "update_invoice_status",
    with_sources(
        "invoices",
        select=f"""
SELECT invoice_id, invoice_no, invoice_date, seller_id, client_id, total_net_worth, total_vat, created_at,
       CASE WHEN status = 'UNPAID' THEN total_net_worth ELSE total_gross_worth END AS total_gross_worth,
       CASE WHEN status = 'UNPAID' THEN 'PARTIALLY_PAID' ELSE status END AS status,
       CASE WHEN status = 'UNPAID' THEN TIMESTAMP '{NOW}' ELSE updated_at END AS updated_at
FROM invoices""",
    ),
)
def update_status(spark, folder):
    changes = {"status": "PARTIALLY_PAID", "total_gross_worth": F.col("total_net_worth")}
    return dml.update_where(fixtures.invoices(spark, folder), F.col("status") == "UNPAID", changes, NOW)


@query(
    "update_without_stamp",
    with_sources(
        "payments",
        select="""
SELECT * REPLACE (CASE WHEN payment_method = 'WIRE' THEN 'BANK_TRANSFER' ELSE payment_method END AS payment_method)
FROM payments""",
    ),
)
def update_payments(spark, folder):
    wire = F.col("payment_method") == "WIRE"
    return dml.update_where(fixtures.payments(spark, folder), wire, {"payment_method": "BANK_TRANSFER"})


@query(
    "delete_where",
    with_sources("invoices", select="SELECT * FROM invoices WHERE seller_id IS NULL OR seller_id >= 50"),
)
def delete_rows(spark, folder):
    """Invoices without a seller stay: the condition is NULL for them."""
    return dml.delete_where(fixtures.invoices(spark, folder), F.col("seller_id") < 50)


ALL_PRODUCTS = """
every AS (
  SELECT * FROM products
  UNION ALL
  SELECT 1000000000 + n_nationkey, n_name, CASE WHEN n_regionkey = 0 THEN 'PROMO' ELSE 'NATION' END,
         CAST(n_nationkey + 1 AS DECIMAL(12,2)), CAST(10.00 AS DECIMAL(5,2)), TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-01'
  FROM nation)"""


def _every_product(spark, folder):
    """The products, and one for each nation that no item refers to."""
    products = fixtures.products(spark, folder)
    made = F.lit("2024-01-01").cast("timestamp_ntz")
    unsold = fixtures.raw(spark, folder, "nation").select(
        (F.col("n_nationkey") + 1_000_000_000).alias("product_id"),
        F.col("n_name").alias("product_name"),
        F.when(F.col("n_regionkey") == 0, "PROMO").otherwise("NATION").alias("product_description"),
        (F.col("n_nationkey") + 1).alias("unit_price"),
        F.lit("10.00").alias("vat_rate"),
        made.alias("created_at"),
        made.alias("updated_at"),
    )
    return products.unionByName(unsold.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in products.schema)))


@query(
    "restrict_blockers",
    with_sources(
        "products",
        then=ALL_PRODUCTS,
        select="""
SELECT * FROM every WHERE product_description = 'PROMO' AND product_id IN (SELECT l_partkey FROM lineitem)""",
    ),
)
def blockers(spark, folder):
    items = fixtures.invoice_items(spark, folder, numbered=False)
    doomed = _every_product(spark, folder).where("product_description = 'PROMO'")
    return dml.restrict_blockers(doomed, "product_id", items, "product_id")


@query(
    "restrict_free",
    with_sources(
        "products",
        then=ALL_PRODUCTS,
        select="SELECT * FROM every WHERE product_id NOT IN (SELECT l_partkey FROM lineitem)",
    ),
)
def free(spark, folder):
    items = fixtures.invoice_items(spark, folder, numbered=False)
    return dml.without_children(_every_product(spark, folder), "product_id", items.select("product_id"))


# -- a stored source model, changed -----------------------------------------

BLOCK_ROWS = 4096
DOOMED = "seller_address = 'Nation 7'"


def _stored(spark, folder):
    """The six tables in a store, then: a seller group is deleted with all that
    hangs on it, prices are raised, a seller and two products are inserted."""

    def build():
        store = open_source(spark, fresh_path(spark, "source"), BLOCK_ROWS, buckets=16)
        tx = store.begin()
        for name, reader in fixtures.READERS.items():
            rows = numbered_items(spark, folder) if name == "invoice_items" else reader(spark, folder)
            dml.insert(tx, name, rows, NOW, check=False)
        tx.commit()
        tx = store.begin()
        dml.delete(tx, "sellers", F.expr(DOOMED))
        raised = (F.col("unit_price") + 1).cast("decimal(12,2)")
        dml.update(tx, "products", F.col("product_description") == "PROMO", {"unit_price": raised}, NOW)
        names = fixtures.raw(spark, folder, "nation").select(
            F.col("n_name").alias("product_name"), (F.col("n_nationkey") + 1).cast("decimal(12,2)").alias("unit_price")
        )
        dml.insert(tx, "products", names, NOW)
        tx.commit()
        return store

    return once(spark, "stored", folder, build)


GONE = f"""
gone AS (SELECT invoice_id FROM invoices WHERE seller_id IN (SELECT seller_id FROM sellers WHERE {DOOMED}))"""


@query("cascade_sellers", with_sources("sellers", select=f"SELECT * FROM sellers WHERE NOT {DOOMED}"))
def cascade_sellers(spark, folder):
    return _stored(spark, folder).read("sellers")


@query(
    "cascade_invoices",
    with_sources(
        "sellers",
        "invoices",
        then=GONE,
        select="SELECT * FROM invoices WHERE invoice_id NOT IN (SELECT invoice_id FROM gone)",
    ),
)
def cascade_invoices(spark, folder):
    return _stored(spark, folder).read("invoices")


@query(
    "cascade_items",
    with_sources(
        "sellers",
        "invoices",
        "invoice_items",
        then=GONE,
        select="SELECT * FROM invoice_items WHERE invoice_id NOT IN (SELECT invoice_id FROM gone)",
    ),
)
def cascade_items(spark, folder):
    return _stored(spark, folder).read("invoice_items")


@query(
    "cascade_payments",
    with_sources(
        "sellers",
        "invoices",
        "payments",
        then=GONE,
        select="SELECT * FROM payments WHERE invoice_id NOT IN (SELECT invoice_id FROM gone)",
    ),
)
def cascade_payments(spark, folder):
    return _stored(spark, folder).read("payments")


@query(
    "kept_totals",
    with_sources(
        "sellers",
        "invoices",
        "payments",
        then=GONE,
        select="""
SELECT invoice_id, count(*) AS payments, CAST(sum(amount) AS DECIMAL(24,2)) AS paid
FROM payments WHERE invoice_id NOT IN (SELECT invoice_id FROM gone) GROUP BY invoice_id""",
    ),
)
def kept_totals(spark, folder):
    """What the store says was paid for each invoice, after an insert of all payments and a delete with cascades."""
    return _stored(spark, folder).read("payment_totals")


@query(
    "invoice_point_stored",
    with_sources(*SOURCE_TABLES, then=GONE, select=DETAIL + "WHERE invoice_no = 'INV-42' AND invoice_id NOT IN (FROM gone)"),
)
def invoice_point_stored(spark, folder):
    """One invoice of a store: its id by the index of numbers, its rows from its own blocks."""
    return reads.invoice_detail(_stored(spark, folder), "INV-42")


@query(
    "stored_index",
    with_sources(
        "products",
        select="""
SELECT product_name, product_id FROM products
UNION ALL
SELECT n_name, (SELECT max(product_id) FROM products) + row_number() OVER (ORDER BY n_name, n_nationkey) FROM nation""",
    ),
)
def stored_index(spark, folder):
    """Every stored product by its name."""
    tx = _stored(spark, folder).begin()
    return tx.ids_of("products", tx.read("products").select("product_name"))


@query(
    "stored_update_insert",
    with_sources(
        "products",
        select=f"""
SELECT product_id, product_name, product_description,
       CASE WHEN product_description = 'PROMO' THEN CAST(unit_price + 1 AS DECIMAL(12,2)) ELSE unit_price END AS unit_price,
       vat_rate, created_at,
       CASE WHEN product_description = 'PROMO' THEN TIMESTAMP '{NOW}' ELSE updated_at END AS updated_at
FROM products
UNION ALL
SELECT (SELECT max(product_id) FROM products) + row_number() OVER (ORDER BY n_name, n_nationkey), n_name, NULL,
       CAST(n_nationkey + 1 AS DECIMAL(12,2)), CAST(10 AS DECIMAL(5,2)), TIMESTAMP '{NOW}', TIMESTAMP '{NOW}'
FROM nation""",
    ),
)
def stored_products(spark, folder):
    return _stored(spark, folder).read("products")


@query(
    "touched_at",
    with_sources(
        "clients",
        select=f"SELECT client_id, TIMESTAMP '{NOW}' AS updated_at FROM clients",
    ),
)
def touched(spark, folder):
    """An update that changes nothing still touches its rows."""
    same = dml.update_where(fixtures.clients(spark, folder), F.lit(True), {"iban": F.col("iban")}, NOW)
    return same.select("client_id", "updated_at")


@query("restrict_delete_refused", SQL["stored_update_insert"])
def restrict_delete_refused(spark, folder):
    """Products that items name cannot be deleted, those without items among them included: all rows stay."""
    store = _stored(spark, folder)
    tx = store.begin()
    try:
        dml.delete(tx, "products", F.lit(True))
    except quality.ConstraintError:
        return tx.read("products")
    raise AssertionError("the delete was not refused")
