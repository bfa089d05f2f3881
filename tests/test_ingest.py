import json
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tallyfold.plans.ingest import ingest_invoices, judge_lines, open_source
from tallyfold.sources.invoice_lines import number_lines, read_invoice_lines, split_document, stage_lines

NOW = "2024-05-01 10:00:00"


def item(name="table", qty="3,00", price="2,50", **more):
    return {"item_desc": name, "item_qty": qty, "item_net_price": price, "item_vat": "10%", **more}


def document(no="1", items=None, summary=None, drop=(), **header):
    values = {
        "seller": "Seller",
        "seller_tax_id": "S-1",
        "client": "Client",
        "client_tax_id": "C-1",
        "iban": "IB",
        "invoice_no": no,
        "invoice_date": "1/5/2021",
        **header,
    }
    for key in drop:
        values.pop(key, None)
    totals = {"total_net_worth": "$ 7,50", "total_vat": "$0.75", "total_gross_worth": "$8.25", **(summary or {})}
    return {"gt_parse": {"header": values, "items": [item()] if items is None else items, "summary": totals}}


@pytest.fixture
def judged(spark, tmp_path):
    """Reasons and items of lines, by policy."""

    def judge(docs, policy="line"):
        path = tmp_path / f"lines-{policy}-{len(list(tmp_path.iterdir()))}.txt"
        path.write_text("\n".join(d if isinstance(d, str) else json.dumps(d) for d in docs) + "\n", encoding="utf-8")
        lines = stage_lines(judge_lines(split_document(read_invoice_lines(spark, str(path))), policy))
        return lines.orderBy("line_no").collect()

    return judge


LINES = [
    # (document, reason under policy line, reason under policy item)
    (document(), None, None),
    (document(items=[]), None, None),
    (document(items=[item(), item("chair")]), None, None),
    (document(invoice_date="01/05/2021"), None, None),
    (document(invoice_date="13/01/2021"), "invoice_date is no date", "invoice_date is no date"),
    ("not json", "not a JSON document", "not a JSON document"),
    ("", "not a JSON document", "not a JSON document"),
    (json.dumps(document()) + " x", "not a JSON document", "not a JSON document"),
    (json.dumps(document()) + json.dumps(document()), "not a JSON document", "not a JSON document"),
    (json.dumps(document()) + "," + json.dumps(document()), "not a JSON document", "not a JSON document"),
    (json.dumps(document()) + "] {}", "not a JSON document", "not a JSON document"),
    ("\t " + json.dumps(document()) + " \t", None, None),
    (json.dumps(document()).replace('"iban"', '"seller": 5, "seller": "last", "iban"'), None, None),
    ("[]", "seller_tax_id is no text", "seller_tax_id is no text"),
    (document(drop=["iban"]), "iban is missing or nested", "iban is missing or nested"),
    (document(iban=None), None, None),
    (document(seller_tax_id=None), "seller_tax_id is no text", "seller_tax_id is no text"),
    (document(seller_tax_id="9" * 31), "seller_tax_id is too long", "seller_tax_id is too long"),
    (document(client=7), None, None),
    (document(client=["x"]), "client is missing or nested", "client is missing or nested"),
    (document(seller="s" * 256), None, None),  # left to settle_lines
    (document(no="n" * 51), "invoice_no is too long", "invoice_no is too long"),
    (document(summary={"total_vat": 1}), "total_vat is no text", "total_vat is no text"),
    (document(summary={"total_vat": "x"}), "total_vat is no amount in range", "total_vat is no amount in range"),
    (document(items="x"), "items is no list", "items is no list"),
    (document(items=[item(qty="bad")]), "item_qty is no number text", None),
    (document(items=[item(qty=3)]), "item_qty is no number text", None),
    (document(items=[item(price="1,234.56")]), "item_net_price is no number text", None),
    (document(items=[item(item_vat=None)]), "item_vat is no number text", None),
    (document(items=[item(item_vat="8 %")]), None, None),
    (document(items=[{k: v for k, v in item().items() if k != "item_vat"}]), None, None),
    (document(items=[{"item_qty": "1"}]), "item_desc is missing", None),
    (document(items=[5]), "item_desc is missing", None),
    (document(items=[item(name=None)]), "item_desc is no text", "item_desc is no text"),
    (document(items=[item(qty="0")]), "item_qty_positive fails", "item_qty_positive fails"),
    (document(items=[item(qty="-1")]), "item_qty_positive fails", "item_qty_positive fails"),
    (document(items=[item(qty="999999999")]), "item_qty is out of range", "item_qty is out of range"),
    (document(items=[item(price="99999999999")]), "item_net_price is out of range", "item_net_price is out of range"),
    (
        document(items=[item(qty="99999999", price="9999999999")]),
        "item_net_worth is out of range",
        "item_net_worth is out of range",
    ),
]


@pytest.mark.parametrize("policy, place", [("line", 1), ("item", 2)])
def test_reasons(judged, policy, place):
    got = [r["reason"] for r in judged([entry[0] for entry in LINES], policy)]
    assert got == [entry[place] for entry in LINES]


def test_rejected_lines_keep_their_text(judged):
    good, bad = judged([document(), "oops"])
    assert good["line"] is None and good["items"] is not None
    assert bad["line"] == "oops" and bad["items"] is None
    assert [good["line_no"], bad["line_no"]] == [1, 2]


def test_amounts(judged):
    (row,) = judged([document(summary={"total_net_worth": "$ 8,25", "total_vat": " $1,234.56 "})])
    assert (row["total_net_worth"], row["total_vat"]) == (D("825.00"), D("1234.56"))
    (parsed,) = row["items"]
    assert (parsed["item_qty"], parsed["item_net_price"], parsed["item_net_worth"]) == (D("3.00"), D("2.50"), D("7.50"))
    assert parsed["item_gross_worth"] == D("8.25")


def test_lines_of_many_splits_are_numbered_in_order(spark, tmp_path):
    for f in range(3):
        (tmp_path / f"part-{f}.txt").write_text("".join(f"{f}-{i}\n" for i in range(2000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        from tallyfold.session import stage

        staged = stage(read_invoice_lines(spark, str(tmp_path)))
        assert staged.select("file", "split").distinct().count() > 10
        lines = number_lines(staged).orderBy("line_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r["line_no"] for r in lines] == list(range(1, 6001))
    assert [r["line"] for r in lines] == [f"{f}-{i}" for f in range(3) for i in range(2000)]


def load(spark, root, docs, policy="line", name="a.txt", store=None, **options):
    import os

    os.makedirs(root, exist_ok=True)
    path = f"{root}/{name}"
    with open(path, "w", encoding="utf-8") as f:
        f.writelines((d if isinstance(d, str) else json.dumps(d)) + "\n" for d in docs)
    store = store or open_source(spark, f"{root}/store", block_rows=3)
    return store, ingest_invoices(spark, path, store, policy, NOW, **options)


def values(store, table, *names):
    return sorted(tuple(r) for r in store.read(table).select(*names).collect())


def test_first_occurrence_wins_and_ids_follow_input_order(spark, root):
    docs = [
        document("10", seller="A", seller_tax_id="S-2", items=[item("b", price="5"), item("a", price="1")]),
        "broken",
        document("11", seller="B", seller_tax_id="S-1", items=[item("a", price="9", item_vat="8%")]),
        document("12", seller="other name", seller_tax_id="S-2", items=[item("c")]),
        document("10", seller="B", seller_tax_id="S-1", items=[item("b", price="7")], invoice_date="2/2/2022"),
    ]
    store, report = load(spark, root, docs)
    assert (report.lines, report.accepted, report.rejected) == (5, 4, 1)
    assert values(store, "sellers", "seller_id", "seller_name", "seller_address", "seller_tax_id", "iban") == [
        (1, "A", "A", "S-2", "IB"),
        (2, "B", "B", "S-1", "IB"),
    ]
    assert values(store, "products", "product_id", "product_name", "unit_price", "vat_rate") == [
        (1, "b", D("5.00"), D("10.00")),
        (2, "a", D("1.00"), D("10.00")),
        (3, "c", D("2.50"), D("10.00")),
    ]
    assert values(store, "invoices", "invoice_id", "invoice_no", "seller_id", "status") == [
        (1, "10", 1, "UNPAID"),
        (2, "11", 2, "UNPAID"),
        (3, "12", 1, "UNPAID"),
    ]
    # The repeated invoice keeps its header; its items are added again.
    assert values(store, "invoice_items", "item_id", "invoice_id", "product_id", "item_net_price") == [
        (1, 1, 1, D("5.00")),
        (2, 1, 2, D("1.00")),
        (3, 2, 2, D("9.00")),
        (4, 3, 3, D("2.50")),
        (5, 1, 1, D("7.00")),
    ]
    assert values(store, "rejected_lines", "line_no", "reason", "line") == [(2, "not a JSON document", "broken")]

    # A second load finds what exists and goes on with the ids.
    store, _ = load(spark, root, [document("11"), document("13", items=[item("c"), item("d")])], name="b.txt", store=store)
    assert values(store, "sellers", "seller_id") == [(1,), (2,)]
    assert values(store, "products", "product_id", "product_name")[3:] == [(4, "table"), (5, "d")]
    assert values(store, "invoices", "invoice_id", "invoice_no")[3:] == [(4, "13")]
    assert values(store, "invoice_items", "item_id", "invoice_id", "product_id")[5:] == [(6, 2, 4), (7, 4, 3), (8, 4, 5)]

    # Optionally, known invoices add nothing.
    store, _ = load(
        spark, root, [document("11"), document("14"), document("14")], name="c.txt", store=store, skip_known_invoices=True
    )
    assert values(store, "invoices", "invoice_id", "invoice_no")[4:] == [(5, "14")]
    assert values(store, "invoice_items", "item_id", "invoice_id")[8:] == [(9, 5)]


def test_rejected_line_creates_nothing(spark, root):
    docs = [document("1", seller_tax_id="S-9", items=[item("gone"), item("bad", qty="x")])]
    store, report = load(spark, root, docs)
    assert report.accepted == 0
    assert all(store.read(t).count() == 0 for t in ("sellers", "clients", "products", "invoices", "invoice_items"))


def test_bad_quantity_alone_leaves_the_product(spark, root):
    docs = [document("1", items=[item("only product", qty="x"), item("none", price="x"), item("kept")])]
    store, report = load(spark, root, docs, "item")
    assert report.accepted == 1
    assert values(store, "products", "product_id", "product_name") == [(1, "only product"), (2, "kept")]
    assert values(store, "invoice_items", "item_id", "product_id") == [(1, 2)]


def test_payments_set_the_status(spark, root):
    docs = [document("1"), document("2"), document("3")]
    payments = spark.createDataFrame(
        [("1", "CASH", D("8.00")), ("1", "ONLINE", D("0.25")), ("2", "CASH", D("1.00")), ("9", "CASH", D("1.00"))],
        "invoice_no string, payment_method string, amount decimal(14,2)",
    )
    store, _ = load(spark, root, docs, "item", payments=payments)
    assert values(store, "invoices", "invoice_no", "status") == [("1", "PAID"), ("2", "PARTIALLY_PAID"), ("3", "UNPAID")]
    assert values(store, "payments", "payment_id", "invoice_id", "amount") == [
        (1, 1, D("0.25")),
        (2, 1, D("8.00")),
        (3, 2, D("1.00")),
    ]


def test_left_out_items_and_payments_are_recorded(spark, root):
    docs = [document("1", items=[item("a"), item("b", qty="x"), item("c", price="y")])]
    payments = spark.createDataFrame(
        [("1", "CASH", D("1.00")), ("1", "WIRE", D("2.00")), ("9", "CASH", D("3.00"))],
        "invoice_no string, payment_method string, amount decimal(14,2)",
    )
    store, _ = load(spark, root, docs, "item", payments=payments)
    assert values(store, "rejected_items", "line_no", "pos", "product_name", "reason") == [
        (1, 1, "b", "item_qty is no number text"),
        (1, 2, "c", "item_net_price is no number text"),
    ]
    assert values(store, "rejected_payments", "invoice_no", "amount", "reason") == [
        ("1", "2.00", "payment_method_known fails"),
        ("9", "3.00", "invoice_no refers to no invoice"),
    ]
    assert values(store, "payments", "payment_id", "amount") == [(1, D("1.00"))]


def test_product_rules_matter_only_for_new_products(spark, root):
    """An item that is left out anyway may name a price that fits no column, if its product exists by then."""
    far = "99999999999"
    docs = [
        document("1", items=[item("p", price=far, qty="x")]),  # p does not exist yet
        document("2", items=[item("p")]),
        document("3", items=[item("p", price=far, qty="x"), item("q")]),  # now it does
        document("4", items=[item("r"), item("r", price=far, qty="x")]),  # made by the item before
        document("5", items=[item("s", price=far, qty="x"), item("s")]),
        # In question itself, but stands, and so makes t known.
        document("6", items=[item("p", price=far, qty="x"), item("t")]),
        document("7", items=[item("t", price=far, qty="x")]),
        document("8", items=[item("p", price=far)]),  # the item itself fits no column
    ]
    store, _ = load(spark, root, docs, "item")
    assert values(store, "invoices", "invoice_no") == [("2",), ("3",), ("4",), ("6",), ("7",)]
    assert values(store, "products", "product_name") == [("p",), ("q",), ("r",), ("t",)]
    out_of_range = "item_net_price is out of range"
    assert values(store, "rejected_lines", "line_no", "reason") == [(1, out_of_range), (5, out_of_range), (8, out_of_range)]
    assert values(store, "rejected_items", "line_no", "pos") == [(3, 0), (4, 1), (6, 0), (7, 0)]


def test_worths_are_exact(spark, root):
    docs = [document("1", items=[item("a", qty="2,9999996", price="1000000"), item("b", qty="1", price="1000000", item_vat="8.33333%")])]
    store, _ = load(spark, root, docs)
    found = [r[0] for r in store.read("invoice_items").orderBy("item_id").select("item_net_worth").collect()]
    assert found == [D("2999999.60"), D("1000000.00")]
    assert store.read("invoice_items").where("item_id = 2").first()["item_gross_worth"] == D("1083333.30")


def test_names_matter_only_for_new_parties(spark, root):
    """A name that could not be stored is no fault when the party exists already."""
    long = "n" * 256
    docs = [
        document("1", seller=long, seller_tax_id="S-1"),  # S-1 does not exist yet
        document("2", seller="Good", seller_tax_id="S-1"),
        document("3", seller=long, seller_tax_id="S-1"),  # now it does
        document("4", client=None, client_tax_id="C-2"),
        # Its client is new and well named, its seller ill named but known: it makes C-2 known.
        document("5", seller=None, seller_tax_id="S-1", client="C two", client_tax_id="C-2"),
        document("6", client=None, client_tax_id="C-2", iban="i" * 51),
    ]
    store, report = load(spark, root, docs)
    assert values(store, "invoices", "invoice_no") == [("2",), ("3",), ("5",), ("6",)]
    assert values(store, "rejected_lines", "line_no", "reason") == [(1, "seller is too long"), (4, "client is null")]
    assert values(store, "clients", "client_name") == [("C two",), ("Client",)]
    # The next load knows all parties from the start.
    store, report = load(spark, root, [document("7", seller=None, seller_tax_id="S-1")], name="b.txt", store=store)
    assert report.accepted == 1


def test_items_shuffle_by_product_not_collected(spark, root):
    """Find-or-create keeps one row per name and task before the shuffle."""
    from tallyfold.operators.merge import insert_ignore

    items = spark.range(1000).select(F.lit("same").alias("product_name"), F.col("id").alias("line_no"))
    new = insert_ignore(items.where("false"), items, "product_name", F.col("line_no"))
    assert "partial_min_by" in new._jdf.queryExecution().executedPlan().toString()
    assert new.count() == 1


@pytest.mark.parametrize(
    "text, fine",
    [("1.12345678", False), ("1.123456780000", False), ("1.123456789", True), ("0.000000001", True), ("1e-9", True),
     ("1.5e-7", False), ("1.123456789e3", False), ("12345678.5", False), (" 1.000000001 ", True), ("1_0.123456789", True),
     ("99999999999", False), (None, False)],
)
def test_too_fine(spark, text, fine):
    from tallyfold.functions import numbers

    df = spark.createDataFrame([(text,)], "t string").select(F.col("t"), numbers.to_decimal(F.col("t")).alias("v"))
    assert df.select(numbers.too_fine(F.col("t"), F.col("v"))).first()[0] is fine


def test_digits_beyond_the_scale_are_refused_not_rounded(spark, root):
    docs = [document("1", items=[item("a", qty="1.000000004")]), document("2", items=[item("a", item_vat="10.0000001%")])]
    docs += [document("3", items=[item("a", price="2.1234567801")]), document("4", items=[item("a", qty="1.00000000")])]
    store, report = load(spark, f"{root}/line", docs)
    assert report.accepted == 1
    assert values(store, "rejected_lines", "line_no", "reason") == [
        (1, "item_qty has more than 8 decimals"),
        (2, "item_vat has more than 6 decimals"),
        (3, "item_net_price has more than 8 decimals"),
    ]
    store, report = load(spark, f"{root}/item", docs, policy="item")
    assert report.accepted == 4 and store.read("invoice_items").count() == 1
    assert values(store, "rejected_items", "line_no", "reason")[0] == (1, "item_qty has more than 8 decimals")


def test_a_document_is_read_in_one_pass(spark):
    """Beside the mark behind the line and the kind of items that are no list, all that is read of it at once."""
    lines = spark.range(1).select(F.col("id").cast("string").alias("line"))
    found = split_document(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert found.count("variant_get(_doc") == 3


def test_values_of_another_form_are_missing_alone(spark):
    items = '[null, 1, {"item_desc": "a", "item_qty": 2, "item_net_price": "3", "item_vat": null}, {"item_desc": {}}]'
    line = '{"gt_parse": {"header": {"seller": 5, "client": [], "iban": null, "invoice_no": 7, "invoice_date": "d"}, "items": %s}}' % items
    row = split_document(spark.createDataFrame([(line,)], "line string")).first()
    header, empty = row["header"], (None, None, None, None, False, False)
    assert (header["invoice_no"], header["invoice_date"], row["items_kind"], row["summary"][0]) == (None, "d", "ARRAY", None)
    assert [tuple(header[k]) for k in ("seller", "client", "iban")] == [("5", True), ("[]", False), (None, True)]
    assert [tuple(i) for i in row["items"]] == [empty, empty, ("a", None, "3", None, True, True), (None, None, None, None, True, False)]
