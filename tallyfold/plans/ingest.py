"""JSON-lines invoices into the source model.

Every line is parsed and judged once and the outcome is staged as Parquet.
From then on each entity is one set-based job over the accepted lines: find
existing rows by natural key, create the others from their first occurrence
in input order, and give ids in that order.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions import numbers
from tallyfold.functions.calendar import parse_us_date, stamp
from tallyfold.functions.status import payment_status
from tallyfold.operators import quality, totals
from tallyfold.operators.dml import insert, with_defaults
from tallyfold.operators.keys import running_totals
from tallyfold.operators.merge import BROADCAST_BYTES, find_or_create, first_per_key, known_rows, lookup_ids
from tallyfold.operators.settle import settle
from tallyfold.plans.cycle import utc_now
from tallyfold.schemas import CLIENTS, INGEST_TABLES, INVOICES, PRODUCTS, SELLERS
from tallyfold.session import scratch, side_by_side, stage, unstage
from tallyfold.sources.invoice_lines import (
    HEADER_NAMES,
    HEADER_TAX_IDS,
    HEADER_TEXTS,
    SUMMARY_KEYS,
    number_lines,
    read_invoice_lines,
    split_document,
)
from tallyfold.sources.store import TableStore, Transaction

LINE, ITEM = "line", "item"
SUM_BYTES = 32  # of an invoice's id and what was paid, as `row_bytes` counts
# Items are moved to their blocks so many at a time, in at most so many turns.
TURN_ROWS = 1 << 20
MOST_TURNS = 8


def open_source(spark: SparkSession, root: str, block_rows: int = 1 << 20, buckets: int = 64) -> TableStore:
    """The source model at `root`: six tables, the kept totals and what was rejected."""
    return TableStore(spark, root, INGEST_TABLES, block_rows, buckets)


# -- judging lines ----------------------------------------------------------


def _known(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


# An item is worked out in steps, each a pass over the item list: a pass keeps
# its results, where one expression would compute shared parts again and again.


def _with(item: Column, known: tuple[str, ...], **more: Column) -> Column:
    return F.struct(*(item[k].alias(k) for k in known), *(v.alias(k) for k, v in more.items()))


def _item_texts(item: Column) -> Column:
    vat, vat_there = item["item_vat"], item["item_vat_there"]
    return F.struct(
        item["item_desc"].alias("product_name"),
        item["item_desc_there"].alias("named"),
        numbers.item_text(item["item_qty"]).alias("qty"),
        numbers.item_text(item["item_net_price"]).alias("price"),
        numbers.vat_text(vat, vat_there).alias("vat"),
    )


def _item_numbers(item: Column) -> Column:
    return _with(
        item,
        ("product_name", "named", "qty", "price", "vat"),
        qty_value=numbers.to_decimal(item["qty"], numbers.QUANTITY),
        price_value=numbers.to_decimal(item["price"]),
        vat_value=numbers.to_decimal(item["vat"], numbers.RATE),
    )


def _too_fine(item: Column, text: str, type_name: str) -> Column:
    return numbers.too_fine(item[text], item[f"{text}_value"], type_name)


def _item_net(item: Column) -> Column:
    return _with(
        item,
        ("product_name", "named", "vat_value"),
        price_ok=numbers.is_number(item["price"], item["price_value"]),
        vat_ok=numbers.is_number(item["vat"], item["vat_value"]),
        qty_ok=numbers.is_number(item["qty"], item["qty_value"]),
        price_fine=_too_fine(item, "price", numbers.PRICE),
        vat_fine=_too_fine(item, "vat", numbers.RATE),
        qty_fine=_too_fine(item, "qty", numbers.QUANTITY),
        net=numbers.net_worth(item["qty_value"], item["price_value"]),
        item_qty=numbers.store_money(item["qty_value"], 10),
        item_net_price=numbers.store_money(item["price_value"], 12),
        item_vat_rate=numbers.store_money(item["vat_value"], 5),
    )


def _item_stored(item: Column) -> Column:
    return _with(
        item,
        ("product_name", "named", "price_ok", "vat_ok", "qty_ok", "price_fine", "vat_fine", "qty_fine"),
        item_qty=item["item_qty"],
        item_net_price=item["item_net_price"],
        item_vat_rate=item["item_vat_rate"],
        item_net_worth=numbers.store_money(item["net"], 12),
        item_gross_worth=numbers.store_money(numbers.gross_worth(item["net"], item["vat_value"]), 12),
    )


ITEM_COLUMNS = ("item_qty", "item_net_price", "item_vat_rate", "item_net_worth", "item_gross_worth")


def _item_faults(item: Column) -> Column:
    """Why an item fails, if it does.

    `product_fault` keeps even the product from being made, `item_fault` only
    the item, and `line_fault` is a broken rule that takes the line along.
    `product_breach` is a rule that a new product would break, for an item that
    is left out anyway: it takes the line along unless the product exists.
    """
    product_fault = F.coalesce(
        F.when(~item["named"], F.lit("item_desc is missing")),
        F.when(~item["price_ok"], F.lit("item_net_price is no number text")),
        F.when(~item["vat_ok"], F.lit("item_vat is no number text")),
        F.when(item["price_fine"], F.lit("item_net_price has more than 8 decimals")),
        F.when(item["vat_fine"], F.lit("item_vat has more than 6 decimals")),
    )
    item_fault = F.coalesce(
        F.when(~item["qty_ok"], F.lit("item_qty is no number text")),
        F.when(item["qty_fine"], F.lit("item_qty has more than 8 decimals")),
    )
    name_limit = PRODUCTS.column("product_name").max_length
    product_breach = F.coalesce(
        F.when(item["product_name"].isNull(), F.lit("item_desc is no text")),
        F.when(F.length(item["product_name"]) > name_limit, F.lit("product_name is too long")),
        F.when(item["item_net_price"].isNull(), F.lit("item_net_price is out of range")),
        F.when(item["item_vat_rate"].isNull(), F.lit("item_vat_rate is out of range")),
    )
    item_breach = F.coalesce(
        F.when(item["item_qty"].isNull(), F.lit("item_qty is out of range")),
        F.when(~_known(item["item_qty"] > 0), F.lit("item_qty_positive fails")),
        F.when(item["item_net_worth"].isNull(), F.lit("item_net_worth is out of range")),
        F.when(item["item_gross_worth"].isNull(), F.lit("item_gross_worth is out of range")),
    )
    line_fault = F.when(product_fault.isNull() & item_fault.isNull(), F.coalesce(product_breach, item_breach))
    return _with(
        item,
        ("product_name", *ITEM_COLUMNS),
        product_fault=product_fault,
        item_fault=item_fault,
        line_fault=line_fault,
        product_breach=F.when(product_fault.isNull() & item_fault.isNotNull(), product_breach),
    )


def _worked_items(items: Column) -> Column:
    for step in (_item_texts, _item_numbers, _item_net, _item_stored, _item_faults):
        items = F.transform(items, step)
    return items


def _first_fault(items: Column, strict: bool) -> Column:
    """The first reason among the items of a line to refuse the whole line."""

    def fault(item: Column) -> Column:
        if strict:
            return F.coalesce(item["product_fault"], item["line_fault"], item["product_breach"], item["item_fault"])
        return item["line_fault"]

    faults = F.filter(F.transform(items, fault), lambda f: f.isNotNull())
    return F.get(faults, F.lit(0))


def _too_long(key: str, limit: int) -> Column:
    return F.when(F.length(key) > limit, F.lit(f"{key} is too long"))


def _party_fault(singular: str) -> Column:
    """Why a line could not create its seller or client."""
    name_limit = SELLERS.column("seller_name").max_length
    return F.coalesce(
        F.when(F.col(singular).isNull(), F.lit(f"{singular} is null")),
        _too_long(singular, name_limit),
        _too_long("iban", SELLERS.column("iban").max_length),
    )


def _makes_product(item: Column) -> Column:
    """Whether an item of an accepted line makes sure that its product exists."""
    return item["product_fault"].isNull() & item["product_breach"].isNull()


def _asked(items: Column) -> Column:
    """Items (product_name, pos, fault) that need a product which they, and those before them in the line, cannot make."""
    placed = F.transform(items, lambda item, pos: F.struct(item.alias("item"), pos.alias("pos")))

    def open_(at: Column) -> Column:
        made = F.exists(
            placed,
            lambda other: (other["pos"] < at["pos"])
            & (other["item"]["product_name"] == at["item"]["product_name"])
            & _makes_product(other["item"]),
        )
        return at["item"]["product_breach"].isNotNull() & ~F.coalesce(made, F.lit(False))

    return F.transform(
        F.filter(placed, open_),
        lambda at: F.struct(
            at["item"]["product_name"].alias("product_name"),
            at["pos"].alias("pos"),
            at["item"]["product_breach"].alias("fault"),
        ),
    )


def judge_lines(documents: DataFrame, policy: str = LINE, decimal_comma: bool = False) -> DataFrame:
    """Typed fields of each document, and `reason` when the line is refused.

    Under policy `line` any bad item refuses the line. Under policy `item` a
    bad item is left out alone, unless it breaks a rule of the tables.
    `seller_fault` and `client_fault` refuse the line only if that party does
    not exist by then, and `asked`, items whose product could not be made, only
    if that product does not; `settle_lines` decides.
    """
    if policy not in (LINE, ITEM):
        raise ValueError(f"unknown policy {policy!r}")
    header, summary = F.col("header"), F.col("summary")
    typed = documents.select(
        *(c for c in documents.columns if c not in ("header", "summary", "items")),
        *(header[k].alias(k) for k in (*HEADER_TAX_IDS, *HEADER_TEXTS)),
        *(header[k]["text"].alias(k) for k in HEADER_NAMES),
        *(numbers.summary_amount(summary[k], decimal_comma).alias(k) for k in SUMMARY_KEYS),
        parse_us_date(header["invoice_date"]).alias("date"),
        _worked_items(F.col("items")).alias("items"),
        header,
        summary,
    )

    reasons = [
        F.when(~F.col("document"), F.lit("not a JSON document")),
        *(F.when(header[k].isNull(), F.lit(f"{k} is no text")) for k in (*HEADER_TAX_IDS, *HEADER_TEXTS)),
        *(F.when(~_known(header[k]["storable"]), F.lit(f"{k} is missing or nested")) for k in HEADER_NAMES),
        *(F.when(summary[k].isNull(), F.lit(f"{k} is no text")) for k in SUMMARY_KEYS),
        F.when(~_known(F.col("items_kind").startswith("ARRAY")), F.lit("items is no list")),
        F.when(F.col("date").isNull(), F.lit("invoice_date is no date")),
        *(F.when(F.col(k).isNull(), F.lit(f"{k} is no amount in range")) for k in SUMMARY_KEYS),
        *(_too_long(k, SELLERS.column("seller_tax_id").max_length) for k in HEADER_TAX_IDS),
        _too_long("invoice_no", INVOICES.column("invoice_no").max_length),
        _first_fault(F.col("items"), policy == LINE),
    ]
    suspect = F.coalesce("reason", "seller_fault", "client_fault").isNotNull()
    return (
        typed.withColumn("reason", F.coalesce(*reasons))
        .withColumn("seller_fault", F.when(F.col("reason").isNull(), _party_fault("seller")))
        .withColumn("client_fault", F.when(F.col("reason").isNull(), _party_fault("client")))
        .withColumn("asked", F.when(F.col("reason").isNull(), _asked(F.col("items"))))
        .withColumn("line", F.when(suspect | (F.size("asked") > 0), F.col("line")))
        .withColumn("items", F.when(F.col("reason").isNull(), F.col("items")))
        .drop("header", "summary", "document", "items_kind", "invoice_date")
        .withColumnRenamed("date", "invoice_date")
    )


def _first_lines(lines: DataFrame, tax_id: str, fault: str) -> DataFrame:
    """For each tax id the first line that can create the party."""
    able = lines.where(F.col(fault).isNull())
    return able.groupBy(tax_id).agg(F.min("line_no").alias("first"))


def _made_products(lines: DataFrame) -> DataFrame:
    """(line_no, product_name) of the products that each line makes sure to exist."""
    made = lines.select("line_no", F.explode(F.filter("items", _makes_product)).alias("item"))
    return made.select("line_no", F.col("item.product_name").alias("product_name"))


def _first_products(lines: DataFrame) -> DataFrame:
    """For each product the first line that makes it sure to exist."""
    return _made_products(lines).groupBy("product_name").agg(F.min("line_no").alias("first"))


def _stored(tx: Transaction, name: str, wanted: DataFrame, key: str) -> DataFrame:
    """(key, first) of the wanted rows that the table holds; these exist before line 1."""
    return tx.ids_of(name, wanted).select(key, F.lit(0).cast("long").alias("first"))


def settle_lines(tx: Transaction, lines: DataFrame) -> DataFrame:
    """Decide the lines whose seller, client or a product they could not create.

    Such a line stands if each of them exists, in the tables or through an
    earlier line that stands, which may itself be in question: `settle` follows
    these in a number of rounds that grows with the logarithm of the longest
    chain. Without such lines, the usual case, nothing is done.
    """
    parties = [(p, p.natural_key, p.natural_key.replace("tax_id", "fault")) for p in (SELLERS, CLIENTS)]
    sound = F.col("reason").isNull()
    clear = F.col("seller_fault").isNull() & F.col("client_fault").isNull() & (F.size("asked") == 0)
    columns = ["line_no", *HEADER_TAX_IDS, "seller_fault", "client_fault", "asked", "items"]
    open_lines = lines.where(sound & ~clear).select(*columns)
    settled = lines.drop("seller_fault", "client_fault", "asked")
    if open_lines.isEmpty():
        return settled

    open_lines = stage(open_lines, "open")
    needs, makes, known = [], [], []
    for party, tax_id, fault in parties:
        thing = (F.lit(party.name).alias("kind"), F.col(tax_id).alias("name"))
        wanted = open_lines.where(F.col(fault).isNotNull())
        needs.append(wanted.select("line_no", *thing))
        makes.append(open_lines.where(F.col(fault).isNull()).select("line_no", *thing))
        created = _first_lines(lines.where(sound & clear).join(wanted.select(tax_id), tax_id, "left_semi"), tax_id, fault)
        known.append(_stored(tx, party.name, wanted.select(tax_id).distinct(), tax_id).unionByName(created).select(*thing, "first"))
    thing = (F.lit("products").alias("kind"), F.col("product_name").alias("name"))
    asked = open_lines.select("line_no", F.inline("asked"))
    wanted = asked.select("product_name").distinct()
    needs.append(asked.select("line_no", *thing))
    makes.append(_made_products(open_lines).select("line_no", *thing))
    created = _first_products(lines.where(sound & clear)).join(wanted, "product_name", "left_semi")
    known.append(_stored(tx, "products", wanted, "product_name").unionByName(created).select(*thing, "first"))
    together = [stage(reduce(DataFrame.unionByName, rows), "things") for rows in (needs, makes, known)]
    accepted = settle(*together)[0].where("stands")
    refused = open_lines.join(accepted.select("line_no"), "line_no", "left_anti").select(
        "line_no", F.coalesce("seller_fault", "client_fault", F.get("asked", F.lit(0))["fault"]).alias("_refused")
    )
    return (
        settled.join(refused, "line_no", "left")
        .withColumn("reason", F.coalesce("reason", "_refused"))
        .select(*settled.columns)
    )


# -- the job ----------------------------------------------------------------


@dataclass
class IngestReport:
    load_id: str
    lines: int
    accepted: int
    rejected: int


def _typed(tx: Transaction, name: str, now, keep: tuple[str, ...]):
    """Completes new rows of a table: defaults, and the declared types."""
    table = tx.table(name)

    def complete(rows: DataFrame) -> DataFrame:
        full = with_defaults(rows, table, now, keep)
        columns = [c for c in table.columns if c.name != table.key]
        return full.select(*keep, *(F.col(c.name).cast(c.type).alias(c.name) for c in columns))

    return complete


def _create(tx: Transaction, name: str, candidates: DataFrame, now, then: tuple[str, ...] = ()) -> DataFrame:
    """Find-or-create in input order; ids by natural key."""
    return find_or_create(tx, name, candidates, "line_no", then, _typed(tx, name, now, ("line_no", *then)))


def _party(lines: DataFrame, singular: str) -> DataFrame:
    """Name and address are the same header text; both parties get the line's iban."""
    return lines.select(
        F.col(singular).alias(f"{singular}_name"),
        F.col(singular).alias(f"{singular}_address"),
        f"{singular}_tax_id",
        "iban",
        "line_no",
    )


def _spread_items(lines: DataFrame, *keep: str) -> DataFrame:
    """One row per item of the accepted lines, with its place in the line."""
    return lines.select("line_no", *keep, F.posexplode("items").alias("pos", "item")).select(
        "line_no", *keep, "pos", "item.*"
    )


def _products(items: DataFrame) -> DataFrame:
    """Products named by the items, with the price and rate of each item."""
    return items.where(F.col("product_fault").isNull() & F.col("product_breach").isNull()).select(
        "product_name",
        F.col("product_name").alias("product_description"),
        F.col("item_net_price").alias("unit_price"),
        F.col("item_vat_rate").alias("vat_rate"),
        "line_no",
        "pos",
    )


def _create_invoices(tx: Transaction, lines: DataFrame, sellers: DataFrame, clients: DataFrame, now) -> DataFrame:
    """Invoices by number: the first header stays. Parties are looked up for new ones only."""
    header = lines.select("invoice_no", "invoice_date", *HEADER_TAX_IDS, *SUMMARY_KEYS, "line_no")
    typed = _typed(tx, "invoices", now, ("line_no",))

    def complete(new: DataFrame) -> DataFrame:
        linked = lookup_ids(new, sellers, "seller_tax_id", "seller_id")
        return typed(lookup_ids(linked, clients, "client_tax_id", "client_id"))

    return find_or_create(tx, "invoices", header, "line_no", complete=complete)


def _whole(items: Column) -> Column:
    return F.filter(items, lambda item: item["product_fault"].isNull() & item["item_fault"].isNull())


def _placed_items(tx: Transaction, lines: DataFrame, invoices: DataFrame, high: int) -> tuple[DataFrame, int]:
    """The items of accepted lines that are whole, with id and invoice, and the last id; staged.

    Lines, with the number of their `whole` items, are numbered and looked up, not items: an item's id is its place among the whole items
    of its line, after those of the lines before. So items move only where they are written.
    """
    items = F.transform(_whole(F.col("items")), lambda item: F.struct(*(item[c].alias(c) for c in ("product_name", *ITEM_COLUMNS))))
    full = lines.where("whole > 0")
    sizes = lookup_ids(full.select("line_no", "invoice_no", F.col("whole").alias("n")), invoices, "invoice_no", "invoice_id")
    # Staged, as a range partitioning reads its rows twice.
    before, found = running_totals(stage(sizes.drop("invoice_no"), "sizes"), ["line_no"], "n", "before")
    before = stage(before.select("line_no", "invoice_id", (F.col("before") + high + 1).alias("first")), "before")
    items = full.select("line_no", items.alias("items")).join(before, "line_no")
    items = items.select("invoice_id", "first", F.posexplode("items").alias("at", "item"))
    return stage(items.select("invoice_id", (F.col("first") + F.col("at")).alias("_id"), "item.*"), "items"), high + found


def _append_items(tx: Transaction, items: DataFrame, products: DataFrame, last: int, now) -> None:
    """Items are shuffled to their blocks; some blocks at a time, so that not all of them are on the disk twice at once."""
    linked = lookup_ids(items, products, "product_name", "product_id")
    rows = _typed(tx, "invoice_items", now, ("_id",))(linked).withColumnRenamed("_id", "item_id")
    turns = min(-(-items.count() // TURN_ROWS), MOST_TURNS)
    turn = tx.block_of("invoice_items") % max(turns, 1)
    for i in range(turns):
        tx.append("invoice_items", rows.where(turn == i) if turns > 1 else rows)
    tx.raise_high_key("invoice_items", last)


def _left_out(items: DataFrame, load_id: str) -> DataFrame:
    """Items of accepted lines that were left out, with the reason."""
    reason = F.coalesce("product_fault", "item_fault")
    return items.where(reason.isNotNull()).select(
        F.lit(load_id).alias("load_id"), "line_no", F.col("pos").cast("long").alias("pos"), "product_name", reason.alias("reason")
    )


def add_payments(tx: Transaction, payments: DataFrame, now, load_id: str) -> None:
    """Append payments that name their invoice by number, then derive the status
    of the invoices they belong to. Payments of unknown invoices, or that break
    a rule, go to `rejected_payments`."""
    given = stage(payments, "payments")
    found = known_rows(tx.ids_of("invoices", given), given, "invoice_no")
    linked = given.join(found, "invoice_no", "left")
    unknown = F.when(F.col("invoice_id").isNull(), F.lit("invoice_no refers to no invoice"))
    judged = stage(linked.withColumn("reason", F.coalesce(unknown, quality.breach(tx.table("payments"), linked))), "linked")
    named = {c.name: F.col(c.name) if c.name in judged.columns else F.lit(None) for c in tx.table("rejected_payments").columns}
    named["load_id"] = F.lit(load_id)
    refused = judged.where(F.col("reason").isNotNull())
    tx.append("rejected_payments", refused.select(*(c.cast("string").alias(n) for n, c in named.items())))
    good = judged.where(F.col("reason").isNull()).select("invoice_id", *sorted(c for c in payments.columns if c != "invoice_no"))
    insert(tx, "payments", good, now, check=False)
    refresh_status(tx, good, now)


def refresh_status(tx: Transaction, paid: DataFrame, now) -> None:
    """Derive the status of the invoices named by `paid.invoice_id`, which have
    payments; only their blocks are rewritten. What was paid comes from the kept
    totals, no payment is read."""
    ids = stage(paid.select("invoice_id").distinct(), "paid")
    blocks = tx.blocks_of("invoices", ids)
    if not blocks:
        return
    sums = known_rows(totals.of(tx, "payments", ids), ids, "invoice_id")
    sums = stage(sums.select("invoice_id", F.col("paid").alias("_paid")), "sums")
    invoices = tx.read("invoices", blocks)
    few = sums.count() * SUM_BYTES <= BROADCAST_BYTES
    named = F.col("_paid").isNotNull()
    status = payment_status(F.col("_paid"), F.col("total_gross_worth"))
    changed = (
        invoices.join(F.broadcast(sums) if few else sums, "invoice_id", "left")
        .withColumn("status", F.when(named, status).otherwise(F.col("status")))
        .withColumn("updated_at", F.when(named, stamp(now)).otherwise(F.col("updated_at")))
        .select(*invoices.columns)
    )
    # Many sums scatter the rows: gathered again, else each task would write a file for each block.
    tx.rewrite_blocks("invoices", changed if few else tx.gather_blocks("invoices", changed), blocks)


def ingest_invoices(
    spark: SparkSession,
    path: str,
    store: TableStore,
    policy: str = LINE,
    now=None,
    payments: DataFrame | None = None,
    skip_known_invoices: bool = False,
    decimal_comma: bool = False,
    on_read: Callable[[], None] | None = None,
) -> IngestReport:
    """Load one file, folder or glob of JSON-lines invoices; published as one version.

    `payments` may name invoices of this load by `invoice_no`; they are added
    and the status of their invoices derived. A repeated invoice number keeps
    the first header and adds its items again, unless `skip_known_invoices`.
    `on_read` is called when all lines are staged and no file is read any more.
    """
    now = now or utc_now()
    with scratch(spark):
        return _ingest(spark, path, store, policy, now, payments, skip_known_invoices, decimal_comma, on_read)


def _ingest(spark, path, store, policy, now, payments, skip_known_invoices, decimal_comma, on_read) -> IngestReport:
    load_id = uuid.uuid4().hex
    documents = split_document(read_invoice_lines(spark, path))
    # What is counted later is counted here, where the items are at hand.
    parsed = stage(judge_lines(documents, policy, decimal_comma).withColumn("whole", F.size(_whole(F.col("items")))), "lines")
    if on_read:
        on_read()
    judged = number_lines(parsed)

    tx = store.begin()
    lines = settle_lines(tx, judged)
    good = lines.where(F.col("reason").isNull())
    if skip_known_invoices:
        firsts = first_per_key(good.select("invoice_no", "line_no"), "invoice_no", F.col("line_no"))
        firsts = stage(firsts, "firsts")
        firsts = firsts.join(tx.ids_of("invoices", firsts), "invoice_no", "left_anti")
        good = good.join(firsts.select("line_no"), "line_no", "left_semi")
    items = _spread_items(good)
    bad = lines.where(F.col("reason").isNotNull())
    rejected = bad.select(F.lit(load_id).alias("load_id"), "line_no", "reason", "line")
    sellers, clients, products, *_ = side_by_side(
        lambda: _create(tx, "sellers", _party(good, "seller"), now),
        lambda: _create(tx, "clients", _party(good, "client"), now),
        lambda: _create(tx, "products", _products(items), now, ("pos",)),
        lambda: tx.append("rejected_lines", rejected),
        lambda: tx.append("rejected_items", _left_out(items, load_id)),
    )
    invoices = _create_invoices(tx, good, sellers, clients, now)
    counts = lines.agg(F.count("*").alias("n"), F.count("reason").alias("bad")).first()
    placed, last = _placed_items(tx, good, invoices, tx.high_key("invoice_items"))
    # From here on no line is read.
    unstage(parsed)
    _append_items(tx, placed, products, last, now)
    if payments is not None:
        add_payments(tx, payments, now, load_id)
    tx.commit()
    return IngestReport(load_id, counts["n"], counts["n"] - counts["bad"], counts["bad"])
