"""Two incremental cycles over changing sources, and what the star holds after each."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.functions.calendar import stamp
from tallyfold.operators import reads
from tallyfold.plans import fixtures
from tallyfold.plans.cycle import Load, init_marks, init_star, open_star, reset_star, run_cycle
from tallyfold.queries.reads import numbered_items
from tallyfold.queries.registry import once, query, with_sources
from tallyfold.schemas import SOURCE_TABLES
from tallyfold.session import fresh_path
from tallyfold.sources.tables import read_source
from tallyfold.streaming.continuous import one_stream, run_stream, take_batch

FIRST, SECOND = "2024-01-15 00:00:00", "2024-04-01 00:00:00"
CHANGED = "2024-03-01 00:00:00"
BLOCK_ROWS = 1 << 15

# Rows that the source has only from the second cycle on, stamped then.
NEW = {
    "clients": "client_address = 'BUILDING'",
    "sellers": "seller_address LIKE 'Nation 2%'",
    "products": "product_description = 'SMALL'",
    "invoices": "status = 'PARTIALLY_PAID'",
    "invoice_items": "item_vat_rate >= 5",
    "payments": "payment_method = 'CREDIT_CARD'",
}
# Rows whose values change between the cycles, and how.
TOUCHED = {
    "clients": "client_address = 'MACHINERY'",
    "sellers": "seller_address LIKE 'Nation 1%'",
    "products": "product_description = 'ECONOMY'",
    "invoices": "status = 'UNPAID'",
}
VALUES = {
    "clients": {"client_name": "client_name || ' v2'", "client_tax_id": "client_tax_id || '-2'", "iban": "'IB'"},
    "sellers": {"seller_name": "seller_name || ' v2'", "iban": "NULL"},
    "products": {
        "product_name": "product_name || ' v2'",
        "product_description": "product_description || ' v2'",
        "unit_price": "CAST(unit_price + 1 AS DECIMAL(12,2))",
    },
    "invoices": {
        "invoice_no": "invoice_no || 'x'",
        "invoice_date": "CAST('2024-02-29' AS DATE)",
        "total_net_worth": "CAST(0 AS DECIMAL(14,2))",
        "total_gross_worth": "CAST(total_gross_worth + 1 AS DECIMAL(14,2))",
        "status": "'PAID'",
    },
}


def first_source(spark, folder):
    def table(name):
        rows = numbered_items(spark, folder) if name == "invoice_items" else fixtures.READERS[name](spark, folder)
        return rows.where(f"NOT ({NEW[name]})")

    return table


def second_source(spark, folder):
    def table(name):
        rows = numbered_items(spark, folder) if name == "invoice_items" else fixtures.READERS[name](spark, folder)
        column = "updated_at" if "updated_at" in rows.columns else "created_at"
        when = f"({NEW[name]}) OR ({TOUCHED.get(name, 'false')})"
        touched = F.expr(TOUCHED.get(name, "false"))
        changes = {column: F.when(F.expr(when), stamp(CHANGED)).otherwise(F.col(column)).alias(column)}
        for c, value in VALUES.get(name, {}).items():
            changes[c] = F.when(touched, F.expr(value)).otherwise(F.col(c)).alias(c)
        return rows.select(*(changes.get(c, F.col(c)) for c in rows.columns))

    return table


def table_after(spark, folder, table, cycles, mode="idempotent"):
    """A star table after one or two cycles."""

    def first():
        star = open_star(spark, fresh_path(spark, f"star-{mode}"), mode, BLOCK_ROWS)
        init_star(star)
        init_marks(star)
        run_cycle(Load(star, first_source(spark, folder)), FIRST, retries=0)
        return star, star.latest()

    star, version = once(spark, f"star-{mode}-1", folder, first)

    def second():
        run_cycle(Load(star, second_source(spark, folder)), SECOND, retries=0)
        return star.latest()

    if cycles == 2:
        version = once(spark, f"star-{mode}-2", folder, second)
    return star.read(table, version)


# -- the same in SQL --------------------------------------------------------


def _versions(name: str) -> str:
    """CTEs `<name>1` and `<name>2`: the table at the first and second cycle."""
    column = "updated_at" if name in VALUES else "created_at"
    touched = TOUCHED.get(name, "false")
    changes = [f"CASE WHEN {touched} THEN {v} ELSE {c} END AS {c}" for c, v in VALUES.get(name, {}).items()]
    changes.append(f"CASE WHEN ({NEW[name]}) OR ({touched}) THEN TIMESTAMP '{CHANGED}' ELSE {column} END AS {column}")
    return f"""
{name}1 AS (SELECT * FROM {name} WHERE NOT ({NEW[name]})),
{name}2 AS (SELECT * REPLACE ({', '.join(changes)}) FROM {name})"""


def _dimension(name: str, singular: str) -> str:
    """CTEs `dim_<singular>1` and `dim_<singular>2`: id and key after each cycle."""
    key, id_ = f"{singular}_key", f"{singular}_id"
    return f"""
{_versions(name).strip()},
dim_{singular}1 AS (SELECT row_number() OVER (ORDER BY {id_}) AS {key}, {id_} FROM {name}1),
dim_{singular}2 AS (
  SELECT * FROM dim_{singular}1 UNION ALL
  SELECT (SELECT count(*) FROM dim_{singular}1) + row_number() OVER (ORDER BY {id_}), {id_} FROM {name}2
  WHERE updated_at >= TIMESTAMP '{FIRST}' AND {id_} NOT IN (SELECT {id_} FROM dim_{singular}1))"""


def _party_sql(name: str, singular: str, cycle: int) -> str:
    return with_sources(
        name,
        then=_dimension(name, singular),
        select=f"""
SELECT {singular}_key, {singular}_id, {singular}_name, {singular}_address AS {singular}_addr, {singular}_tax_id, iban,
       updated_at
FROM {name}{cycle} JOIN dim_{singular}{cycle} USING ({singular}_id)""",
    )


@query("dim_client_initial", _party_sql("clients", "client", 1))
def dim_client_initial(spark, folder):
    return table_after(spark, folder, "dim_client", 1)


@query("dim_client_increment", _party_sql("clients", "client", 2))
def dim_client_increment(spark, folder):
    return table_after(spark, folder, "dim_client", 2)


@query("dim_seller_initial", _party_sql("sellers", "seller", 1))
def dim_seller_initial(spark, folder):
    return table_after(spark, folder, "dim_seller", 1)


@query("dim_seller_increment", _party_sql("sellers", "seller", 2))
def dim_seller_increment(spark, folder):
    return table_after(spark, folder, "dim_seller", 2)


@query(
    "dim_product_initial",
    with_sources(
        "products",
        then=_dimension("products", "product"),
        select="""
SELECT product_key, product_id, product_name, product_description AS product_desc, unit_price, vat_rate, updated_at
FROM products1 JOIN dim_product1 USING (product_id)""",
    ),
)
def dim_product_initial(spark, folder):
    return table_after(spark, folder, "dim_product", 1)


@query(
    "dim_product_partial_update",
    with_sources(
        "products",
        then=_dimension("products", "product"),
        select="""
SELECT d.product_key, d.product_id, n.product_name, coalesce(o.product_description, n.product_description) AS product_desc,
       n.unit_price, n.vat_rate, n.updated_at
FROM dim_product2 d JOIN products2 n USING (product_id) LEFT JOIN products1 o USING (product_id)""",
    ),
)
def dim_product_increment(spark, folder):
    return table_after(spark, folder, "dim_product", 2)


INVOICE_LOADS = f"""
{_dimension("sellers", "seller").strip()},
{_dimension("clients", "client").strip()},
{_versions("invoices").strip()},
load1 AS (
  SELECT i.*, seller_key, client_key, row_number() OVER (ORDER BY invoice_id) AS invoice_key
  FROM invoices1 i JOIN dim_seller1 USING (seller_id) JOIN dim_client1 USING (client_id)),
batch2 AS (
  SELECT i.*, seller_key, client_key
  FROM invoices2 i JOIN dim_seller2 USING (seller_id) JOIN dim_client2 USING (client_id)
  WHERE i.updated_at >= TIMESTAMP '{FIRST}')"""

FACT_INVOICE = """
SELECT invoice_key, invoice_id, invoice_no, CAST(strftime(invoice_date, '%Y%m%d') AS INT) AS invoice_date_key,
       seller_key, client_key, total_net_worth AS total_net, total_vat, total_gross_worth AS total_gross, status, updated_at
FROM """

PARTIES = ("sellers", "clients", "invoices")


@query("fact_invoice_initial", with_sources(*PARTIES, then=INVOICE_LOADS, select=FACT_INVOICE + "load1"))
def fact_invoice_initial(spark, folder):
    return table_after(spark, folder, "fact_invoice", 1)


@query(
    "fact_invoice_increment",
    with_sources(
        *PARTIES,
        then=INVOICE_LOADS
        + """,
load2 AS (
  SELECT o.* REPLACE (coalesce(n.total_gross_worth, o.total_gross_worth) AS total_gross_worth,
                      coalesce(n.status, o.status) AS status, coalesce(n.updated_at, o.updated_at) AS updated_at)
  FROM load1 o LEFT JOIN batch2 n USING (invoice_id)
  UNION ALL
  SELECT *, (SELECT count(*) FROM load1) + row_number() OVER (ORDER BY invoice_id)
  FROM batch2 WHERE invoice_id NOT IN (SELECT invoice_id FROM load1))""",
        select=FACT_INVOICE + "load2",
    ),
)
def fact_invoice_increment(spark, folder):
    return table_after(spark, folder, "fact_invoice", 2)


ITEM_LOADS = f"""
{_dimension("products", "product").strip()},
{_versions("invoice_items").strip()},
load1 AS (SELECT i.*, product_key FROM invoice_items1 i JOIN dim_product1 USING (product_id)),
load2 AS (
  SELECT i.*, product_key FROM invoice_items2 i JOIN dim_product2 USING (product_id)
  WHERE i.created_at >= TIMESTAMP '{FIRST}')"""

PAYMENT_LOADS = f"""
{_versions("payments").strip()},
load1 AS (SELECT * FROM payments1),
load2 AS (SELECT * FROM payments2 WHERE created_at >= TIMESTAMP '{FIRST}')"""


def _appended(columns: str, id_: str, key: str, lineage: bool) -> str:
    """Both loads, numbered; without the ids of the first load when lineage is kept."""
    unseen = f"WHERE {id_} NOT IN (SELECT {id_} FROM load1)" if lineage else ""
    extra = f", {id_}" if lineage else ""
    return f"""
SELECT row_number() OVER (ORDER BY {id_}) AS {key}, {columns}{extra} FROM load1
UNION ALL
SELECT (SELECT count(*) FROM load1) + row_number() OVER (ORDER BY {id_}), {columns}{extra} FROM load2 {unseen}"""


ITEM_COLUMNS = """invoice_id, product_key, item_qty AS qty, item_net_price AS net_price, item_net_worth AS net_worth,
       item_vat_rate AS vat_rate, item_gross_worth AS gross_worth, created_at"""
PAYMENT_COLUMNS = """invoice_id, CAST(strftime(payment_date, '%Y%m%d') AS INT) AS payment_date_key, amount,
       payment_method AS method, payment_reference AS reference, created_at"""


def _item_sql(lineage):
    select = _appended(ITEM_COLUMNS, "item_id", "invoice_item_key", lineage)
    return with_sources("products", "invoice_items", then=ITEM_LOADS, select=select)


def _payment_sql(lineage):
    select = _appended(PAYMENT_COLUMNS, "payment_id", "payment_key", lineage)
    return with_sources("payments", then=PAYMENT_LOADS, select=select)


@query("fact_item_append", _item_sql(False))
def fact_item_append(spark, folder):
    return table_after(spark, folder, "fact_invoice_item", 2, "append")


@query("fact_item_idempotent", _item_sql(True))
def fact_item_idempotent(spark, folder):
    return table_after(spark, folder, "fact_invoice_item", 2)


@query("fact_payment_append", _payment_sql(False))
def fact_payment_append(spark, folder):
    return table_after(spark, folder, "fact_payment", 2, "append")


@query("fact_payment_idempotent", _payment_sql(True))
def fact_payment_idempotent(spark, folder):
    return table_after(spark, folder, "fact_payment", 2)


@query(
    "dim_date",
    with_sources(
        *PARTIES,
        "payments",
        then=INVOICE_LOADS + ",\n" + _versions("payments").strip(),
        select=f"""
SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, d AS "date", CAST(year(d) AS INT) AS year,
       CAST(quarter(d) AS INT) AS quarter, CAST(month(d) AS INT) AS month, strftime(d, '%b') AS month_name,
       CAST(day(d) AS INT) AS day, CAST(dayofweek(d) + 1 AS INT) AS day_of_week, strftime(d, '%a') AS day_name,
       CAST(week(d) AS INT) AS week_of_year
FROM (SELECT invoice_date AS d FROM load1 UNION SELECT invoice_date FROM batch2 UNION SELECT payment_date FROM payments1
      UNION SELECT payment_date FROM payments2 WHERE created_at >= TIMESTAMP '{FIRST}')""",
    ),
)
def dim_date(spark, folder):
    return table_after(spark, folder, "dim_date", 2)


STREAM_NAMES = "(VALUES ('clients'), ('sellers'), ('products'), ('invoices'), ('invoice_items'), ('payments')) v(stream_name)"


@query("marks_after_cycle", f"SELECT stream_name, TIMESTAMP '{SECOND}' AS last_loaded_ts FROM {STREAM_NAMES}")
def marks_after_cycle(spark, folder):
    return table_after(spark, folder, "etl_watermarks", 2)


@query(
    "cycle_twice",
    with_sources(
        "clients", "sellers", "products", "invoices", "invoice_items", "payments",
        then="linked AS (SELECT i.* FROM invoices i JOIN sellers USING (seller_id) JOIN clients USING (client_id))",
        select="""
SELECT 'clients' AS stream, client_id AS id, client_name || '|' || client_tax_id AS value FROM clients
UNION ALL SELECT 'sellers', seller_id, seller_name || '|' || seller_tax_id FROM sellers
UNION ALL SELECT 'products', product_id, product_name || '|' || CAST(unit_price AS VARCHAR) FROM products
UNION ALL SELECT 'invoices', invoice_id, invoice_no || '|' || CAST(total_gross_worth AS VARCHAR) FROM linked
UNION ALL SELECT 'invoice_items', item_id, CAST(item_qty AS VARCHAR) || '|' || CAST(item_gross_worth AS VARCHAR) FROM invoice_items
UNION ALL SELECT 'payments', payment_id, payment_reference || '|' || CAST(amount AS VARCHAR) FROM payments""",
    ),
)
def cycle_twice(spark, folder):
    """Two cycles over the same unchanged source, with marks before all rows, store each row once, with its values."""
    star = open_star(spark, fresh_path(spark, "star-twice"), block_rows=BLOCK_ROWS)
    init_star(star)
    init_marks(star)

    def table(name):
        return numbered_items(spark, folder) if name == "invoice_items" else fixtures.READERS[name](spark, folder)

    for _ in range(2):
        run_cycle(Load(star, table), "1950-01-01 00:00:00", retries=0)
    stored = {
        "clients": ("dim_client", "client_id", "client_name", "client_tax_id"),
        "sellers": ("dim_seller", "seller_id", "seller_name", "seller_tax_id"),
        "products": ("dim_product", "product_id", "product_name", "unit_price"),
        "invoices": ("fact_invoice", "invoice_id", "invoice_no", "total_gross"),
        "invoice_items": ("fact_invoice_item", "item_id", "qty", "gross_worth"),
        "payments": ("fact_payment", "payment_id", "reference", "amount"),
    }
    parts = [
        star.read(t).select(F.lit(stream).alias("stream"), F.col(i).alias("id"), F.concat_ws("|", a, b).alias("value"))
        for stream, (t, i, a, b) in stored.items()
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


@query(
    "verify_newest_clients",
    with_sources(
        "clients",
        then=_dimension("clients", "client"),
        select="""
SELECT client_key, client_id, client_name, updated_at FROM clients2 JOIN dim_client2 USING (client_id)
ORDER BY updated_at DESC NULLS FIRST, client_id""",
    ),
)
def verify_newest(spark, folder):
    found = reads.recent(table_after(spark, folder, "dim_client", 2), "updated_at", "client_id")
    return found.select("client_key", "client_id", "client_name", "updated_at")


@query(
    "star_reset",
    with_sources(
        "clients", "sellers", "products", "invoices", "invoice_items", "payments",
        then="""linked AS (SELECT i.* FROM invoices i JOIN sellers USING (seller_id) JOIN clients USING (client_id)),
days AS (SELECT invoice_date AS d FROM linked UNION SELECT payment_date FROM payments)""",
        select="""
SELECT 'dim_client' AS name, count(*) AS before, 0 AS after FROM clients
UNION ALL SELECT 'dim_seller', count(*), 0 FROM sellers
UNION ALL SELECT 'dim_product', count(*), 0 FROM products
UNION ALL SELECT 'dim_date', count(*), 0 FROM days
UNION ALL SELECT 'fact_invoice', count(*), 0 FROM linked
UNION ALL SELECT 'fact_invoice_item', count(*), 0 FROM invoice_items
UNION ALL SELECT 'fact_payment', count(*), 0 FROM payments
UNION ALL SELECT 'etl_watermarks', 6, 0""",
    ),
)
def star_reset(spark, folder):
    """Rows of all eight tables before and after a reset."""
    root = _landed(spark, folder)
    star = open_star(spark, fresh_path(spark, "star-reset"), block_rows=BLOCK_ROWS)
    init_star(star)
    init_marks(star)
    run_cycle(Load(star, lambda name: read_source(spark, root, name)), FIRST, retries=0)
    full = star.latest()
    reset_star(star)

    def rows(table, version, column):
        return star.read(table, version).select(F.lit(table).alias("name"), F.lit(column).alias("column"))

    parts = [rows(t, v, c) for t in star.tables for v, c in ((full, "before"), (None, "after"))]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    n = [F.count_if(F.col("column") == c) for c in ("before", "after")]
    return union.groupBy("name").agg(n[0].alias("before"), n[1].cast("int").alias("after"))


def _landed(spark, folder):
    """The six source tables as Parquet folders."""

    def build():
        root = fresh_path(spark, "landed")
        for name in SOURCE_TABLES:
            rows = numbered_items(spark, folder) if name == "invoice_items" else fixtures.READERS[name](spark, folder)
            rows.write.parquet(f"{root}/{name}", compression="zstd")
        return root

    return once(spark, "landed", folder, build)


@query("read_source", with_sources("invoices", select="SELECT * FROM invoices"))
def scan_source(spark, folder):
    return read_source(spark, _landed(spark, folder), "invoices")


@query(
    "stream_fact_invoice",
    with_sources(
        "sellers",
        "clients",
        "invoices",
        select="""
SELECT row_number() OVER (ORDER BY invoice_id) AS invoice_key, invoice_id, invoice_no,
       CAST(strftime(invoice_date, '%Y%m%d') AS INT) AS invoice_date_key, seller_key, client_key,
       total_net_worth AS total_net, total_vat, total_gross_worth AS total_gross, status, updated_at
FROM invoices
JOIN (SELECT seller_id, row_number() OVER (ORDER BY seller_id) AS seller_key FROM sellers) USING (seller_id)
JOIN (SELECT client_id, row_number() OVER (ORDER BY client_id) AS client_key FROM clients) USING (client_id)""",
    ),
)
def stream_fact_invoice(spark, folder):
    """The continuous cycle over the landed folders, until all files are taken."""
    root = _landed(spark, folder)
    star = open_star(spark, fresh_path(spark, "star-stream"), block_rows=BLOCK_ROWS)
    init_star(star)
    init_marks(star)
    folders = {name: f"{root}/{name}" for name in SOURCE_TABLES}
    run = run_stream(spark, star, folders, fresh_path(spark, "stream-state"), interval=None, retries=0)
    run.awaitTermination()
    return star.read("fact_invoice")


LATE = "2020-01-01 00:00:00"


def _streamed_twice(spark, folder):
    """A second landing behind the first: an older version of every client and a newer one of some, every payment once
    more, and as many new payments stamped long before the first mark."""

    def build():
        landed, root = _landed(spark, folder), fresh_path(spark, "landed-twice")
        twice = ("clients", "payments")
        star = open_star(spark, fresh_path(spark, "star-stream-twice"), block_rows=BLOCK_ROWS)
        init_star(star)
        init_marks(star)
        state = fresh_path(spark, "stream-twice-state")

        def land(name, rows):
            rows.write.mode("append").parquet(f"{root}/{name}", compression="zstd")

        # What lands once is taken from where it lies.
        folders = {name: f"{root if name in twice else landed}/{name}" for name in SOURCE_TABLES}

        def take():
            run_stream(spark, star, folders, state, interval=None, retries=0).awaitTermination()

        for name in twice:
            land(name, spark.read.schema(SOURCE_TABLES[name].schema).parquet(f"{landed}/{name}"))
        take()
        clients, payments = fixtures.clients(spark, folder), fixtures.payments(spark, folder)
        older = {"client_name": F.lit("old"), "updated_at": stamp("2023-01-01 00:00:00")}
        newer = {"client_name": F.concat("client_name", F.lit(" v2")), "updated_at": stamp(CHANGED)}
        land("clients", clients.withColumns(older))
        land("clients", clients.where(TOUCHED["clients"]).withColumns(newer))
        land("payments", payments)
        late = {"payment_id": F.col("payment_id") + 1_000_000_000, "created_at": stamp(LATE)}
        land("payments", payments.withColumns(late))
        take()
        return star

    return once(spark, "streamed-twice", folder, build)


@query(
    "stream_increment_client",
    with_sources(
        "clients",
        select=f"""
SELECT row_number() OVER (ORDER BY client_id) AS client_key, client_id,
       CASE WHEN {TOUCHED["clients"]} THEN client_name || ' v2' ELSE client_name END AS client_name,
       CASE WHEN {TOUCHED["clients"]} THEN TIMESTAMP '{CHANGED}' ELSE updated_at END AS updated_at
FROM clients""",
    ),
)
def stream_increment_client(spark, folder):
    return _streamed_twice(spark, folder).read("dim_client").select("client_key", "client_id", "client_name", "updated_at")


@query(
    "stream_increment_payment",
    with_sources(
        "payments",
        select=f"""
SELECT row_number() OVER (ORDER BY payment_id) AS payment_key, payment_id, invoice_id, amount, created_at
FROM (SELECT payment_id, invoice_id, amount, created_at FROM payments
      UNION ALL
      SELECT payment_id + 1000000000, invoice_id, amount, TIMESTAMP '{LATE}' FROM payments)""",
    ),
)
def stream_increment_payment(spark, folder):
    found = _streamed_twice(spark, folder).read("fact_payment")
    return found.select("payment_key", "payment_id", "invoice_id", "amount", "created_at")


@query(
    "stream_rows_without_stamp",
    with_sources(
        "payments",
        select="""
SELECT row_number() OVER (ORDER BY payment_id) AS payment_key, payment_id, invoice_id, amount,
       CASE WHEN payment_id % 3 = 0 THEN NULL ELSE created_at END AS created_at
FROM payments""",
    ),
)
def stream_rows_without_stamp(spark, folder):
    """Payments of which every third has no stamp, landed twice: each is stored once."""
    root = fresh_path(spark, "landed-unstamped")
    star = open_star(spark, fresh_path(spark, "star-unstamped"), block_rows=BLOCK_ROWS)
    init_star(star)
    init_marks(star)
    state = fresh_path(spark, "stream-unstamped-state")
    payments = fixtures.payments(spark, folder)
    stamped = F.when(F.col("payment_id") % 3 != 0, F.col("created_at"))
    folders = {name: f"{root}/{name}" for name in SOURCE_TABLES}
    for name, table in SOURCE_TABLES.items():
        spark.createDataFrame([], table.schema).write.parquet(folders[name])
    for _ in range(2):
        payments.withColumn("created_at", stamped).write.mode("append").parquet(folders["payments"])
        run_stream(spark, star, folders, state, interval=None, retries=0).awaitTermination()
    return star.read("fact_payment").select("payment_key", "payment_id", "invoice_id", "amount", "created_at")


@query(
    "stream_replayed_append",
    with_sources(
        "payments",
        select="""
SELECT row_number() OVER (ORDER BY payment_id % 5 = 0, payment_id) AS payment_key, invoice_id, payment_reference AS reference,
       amount, CASE WHEN payment_id % 3 = 0 THEN NULL ELSE created_at END AS created_at
FROM payments""",
    ),
)
def stream_replayed_append(spark, folder):
    """Two batches, each given twice, into a star that does not know source ids: every payment is stored once."""
    star = open_star(spark, fresh_path(spark, "star-replayed"), "append", BLOCK_ROWS)
    init_star(star)
    init_marks(star)
    payments = fixtures.payments(spark, folder)
    rows = payments.withColumn("created_at", F.when(F.col("payment_id") % 3 != 0, F.col("created_at")))
    for number, later in ((0, False), (1, True), (1, True), (0, False)):
        part = one_stream({"payments": rows.where((F.col("payment_id") % 5 == 0) == later)})
        take_batch(star, part, "changes", number, FIRST, retries=0)
    return star.read("fact_payment").select("payment_key", "invoice_id", "reference", "amount", "created_at")
