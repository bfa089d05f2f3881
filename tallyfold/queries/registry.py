"""Registry of checked queries: each a Spark function and the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyfold.session import outside_scratch

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


_kept: dict[tuple, object] = {}


def once(spark: SparkSession, name: str, folder: str, build: Callable[[], object]):
    """Result of `build`, made once per session, name and data folder."""
    key = (spark.sparkContext.applicationId, name, folder)
    if key not in _kept:
        with outside_scratch():
            _kept[key] = build()
    return _kept[key]


# The source tables in SQL, over the given tables.
SOURCES = {
    "clients": """
clients AS (
  SELECT c_custkey AS client_id, c_name AS client_name, c_mktsegment AS client_address,
         'TAX-C-' || c_custkey AS client_tax_id, CAST(NULL AS VARCHAR) AS iban,
         TIMESTAMP '2024-01-01' AS created_at,
         CAST(DATE '2024-01-01' + CAST(c_nationkey AS INT) AS TIMESTAMP) AS updated_at
  FROM customer)""",
    "sellers": """
sellers AS (
  SELECT s_suppkey AS seller_id, s_name AS seller_name, 'Nation ' || s_nationkey AS seller_address,
         'TAX-S-' || s_suppkey AS seller_tax_id, 'IB-' || s_suppkey AS iban,
         TIMESTAMP '2024-01-01' AS created_at,
         CAST(DATE '2024-01-01' + CAST(s_nationkey AS INT) AS TIMESTAMP) AS updated_at
  FROM supplier)""",
    "products": """
products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS product_description,
         CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price, CAST(10.00 AS DECIMAL(5,2)) AS vat_rate,
         TIMESTAMP '2024-01-01' AS created_at,
         CAST(DATE '2024-01-01' + CAST(p_size AS INT) AS TIMESTAMP) AS updated_at
  FROM part)""",
    "invoices": """
invoices AS (
  SELECT o_orderkey AS invoice_id, 'INV-' || o_orderkey AS invoice_no, CAST(o_orderdate AS DATE) AS invoice_date,
         seller_id, o_custkey AS client_id, net AS total_net_worth, vat AS total_vat,
         CAST(net + vat AS DECIMAL(14,2)) AS total_gross_worth,
         CASE o_orderstatus WHEN 'O' THEN 'UNPAID' WHEN 'P' THEN 'PARTIALLY_PAID' WHEN 'F' THEN 'PAID' END AS status,
         CAST(o_orderdate AS TIMESTAMP) AS created_at, CAST(o_orderdate AS TIMESTAMP) AS updated_at
  FROM (SELECT *, CAST(o_totalprice AS DECIMAL(14,2)) AS net,
               CAST(CAST(o_totalprice AS DECIMAL(14,2)) * 0.10 AS DECIMAL(14,2)) AS vat FROM orders) o
  LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS seller_id FROM lineitem GROUP BY l_orderkey) l
    ON l_orderkey = o_orderkey)""",
    "invoice_items": """
invoice_items AS (
  SELECT item_id, invoice_id, product_id, item_qty, item_net_price,
         CAST(item_qty * item_net_price AS DECIMAL(12,2)) AS item_net_worth, item_vat_rate,
         CAST(item_qty * item_net_price + (item_qty * item_net_price) * item_vat_rate * 0.01 AS DECIMAL(12,2))
           AS item_gross_worth, created_at
  FROM (SELECT row_number() OVER (ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
                 l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS item_id,
               l_orderkey AS invoice_id, l_partkey AS product_id,
               CAST(l_quantity AS DECIMAL(10,2)) AS item_qty, CAST(l_extendedprice AS DECIMAL(12,2)) AS item_net_price,
               CAST(CAST(l_tax AS DECIMAL(5,2)) * 100 AS DECIMAL(5,2)) AS item_vat_rate,
               CAST(l_shipdate AS TIMESTAMP) AS created_at
        FROM lineitem) x)""",
    "payments": """
payments AS (
  SELECT event_id AS payment_id, event_id // 4 AS invoice_id, CAST(ts AS DATE) AS payment_date,
         CASE event_type WHEN 'click' THEN 'CASH' WHEN 'purchase' THEN 'BANK_TRANSFER' WHEN 'signup' THEN 'CREDIT_CARD'
              WHEN 'view' THEN 'ONLINE' WHEN 'error' THEN 'WIRE' END AS payment_method,
         'EV-' || event_id AS payment_reference, CAST(CAST(value AS DECIMAL(14,2)) * 1000 AS DECIMAL(14,2)) AS amount,
         CAST(NULL AS VARCHAR) AS remarks, CAST(ts AS TIMESTAMP) AS created_at
  FROM events)""",
}


def with_sources(*names: str, then: str = "", select: str) -> str:
    """A statement over some of the source tables; `then` holds further CTEs."""
    parts = [SOURCES[n].strip() for n in names]
    if then:
        parts.append(then.strip())
    return "WITH " + ",\n".join(parts) + "\n" + select.strip()
