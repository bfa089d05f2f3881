"""The worked example: one invoice with three items and a payment, changed and deleted."""

import datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tallyfold.operators import dml, quality, reads
from tallyfold.operators.quality import ConstraintError
from tallyfold.plans.cycle import Load, init_marks, init_star, open_star, run_cycle
from tallyfold.plans.ingest import open_source
from tallyfold.schemas import INVOICE_ITEMS, INVOICES, PAYMENTS

NOW = datetime.datetime(2024, 5, 1, 10)
LATER = datetime.datetime(2024, 5, 2, 10)


def put(tx, name, rows, schema, now=NOW, **options):
    dml.insert(tx, name, tx.spark.createDataFrame(rows, schema), now, **options)


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    """Shared by all tests: those before the last one publish nothing."""
    store = open_source(spark, str(tmp_path_factory.mktemp("dml")), block_rows=2)
    tx = store.begin()
    put(
        tx,
        "sellers",
        [("Green Trading", "1 Mill Lane", "111-11-1111", "IBAN-ONE")],
        "seller_name string, seller_address string, seller_tax_id string, iban string",
    )
    put(
        tx,
        "clients",
        [("Smith Stores", "2 Field Road", "222-22-2222", "IBAN-ONE")],
        "client_name string, client_address string, client_tax_id string, iban string",
    )
    put(
        tx,
        "products",
        [
            (1, '36" round table', "marble, mosaic", D("1490.00"), D("10")),
            (2, '12" side table', "marble, inlay", D("248.78"), D("10")),
            (3, "6x3 oval table", "white top", D("7193.76"), D("10")),
        ],
        "place long, product_name string, product_description string, unit_price decimal(12,2), vat_rate decimal(5,2)",
        order="place",
    )
    put(
        tx,
        "invoices",
        [("15686725", datetime.date(2021, 11, 3), 1, 1, D("85850.39"), D("8585.04"), D("94435.43"))],
        "invoice_no string, invoice_date date, seller_id long, client_id long, total_net_worth decimal(14,2), "
        "total_vat decimal(14,2), total_gross_worth decimal(14,2)",
    )
    put(
        tx,
        "invoice_items",
        [(1, 1, D("1"), D("1490.00"), D("10")), (1, 2, D("3"), D("248.78"), D("10")), (1, 3, D("2"), D("7193.76"), D("10"))],
        "invoice_id long, product_id long, item_qty decimal(10,2), item_net_price decimal(12,2), item_vat_rate decimal(5,2)",
    )
    put(
        tx,
        "payments",
        [(1, "BANK_TRANSFER", "TXN-15686725-101", D("50000.00"), "first part")],
        "invoice_id long, payment_method string, payment_reference string, amount decimal(14,2), remarks string",
    )
    tx.commit()
    return store


def test_defaults(store):
    invoice = store.read("invoices").first()
    assert (invoice["invoice_id"], invoice["status"], invoice["updated_at"]) == (1, "UNPAID", NOW)
    assert store.read("payments").first()["payment_date"] == NOW.date()
    # Worths are not computed on insert.
    assert {r["item_net_worth"] for r in store.read("invoice_items").collect()} == {None}


def test_detail(store):
    rows = reads.invoice_detail(store.read, "15686725").collect()
    assert sorted(r["product_name"][:3] for r in rows) == ['12"', '36"', "6x3"]
    assert {(r["payment_amount"], r["payment_method"], r["seller_name"]) for r in rows} == {
        (D("50000.00"), "BANK_TRANSFER", "Green Trading")
    }
    assert rows[0].__fields__ == [
        "invoice_no", "invoice_date", "seller_name", "client_name", "product_name", "item_qty", "item_net_price",
        "item_gross_worth", "payment_amount", "payment_method", "payment_date",
    ]
    assert reads.invoice_detail(store.read, "none").count() == 0


def test_point_read_pushes_the_id_into_the_item_scan(store):
    plan = reads.invoice_detail(store.read, "15686725")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(invoice_no,15686725)" in plan
    assert "EqualTo(invoice_id,1)" in plan


def test_worths(store):
    rows = reads.with_worths(store.read("invoice_items")).orderBy("item_id").collect()
    assert [r["item_net_worth"] for r in rows] == [D("1490.00"), D("746.34"), D("14387.52")]
    assert [r["item_gross_worth"] for r in rows] == [D("1639.00"), D("820.97"), D("15826.27")]


def test_update(store):
    tx = store.begin()
    values = {"total_gross_worth": F.lit("94435.43"), "status": "PARTIALLY_PAID"}
    dml.update(tx, "invoices", F.col("invoice_no") == "15686725", values, LATER)
    dml.update(tx, "products", F.col("product_name") == '36" round table', {"unit_price": F.lit("1550.00")}, LATER)
    invoice = tx.read("invoices").first()
    assert (invoice["status"], invoice["updated_at"], invoice["created_at"]) == ("PARTIALLY_PAID", LATER, NOW)
    prices = {r["product_id"]: (r["unit_price"], r["updated_at"]) for r in tx.read("products").collect()}
    assert prices == {1: (D("1550.00"), LATER), 2: (D("248.78"), NOW), 3: (D("7193.76"), NOW)}
    # Old item prices are not touched by a new product price.
    assert store.read("invoice_items").where("item_net_price = 1550").count() == 0


def test_update_may_not_break_a_rule(store):
    tx = store.begin()
    with pytest.raises(ConstraintError):
        dml.update(tx, "payments", F.lit(True), {"payment_method": "WIRE"}, LATER)


def test_update_is_checked_on_the_new_values(store):
    tx = store.begin()
    with pytest.raises(ConstraintError):
        dml.update(tx, "payments", F.col("payment_method") == "BANK_TRANSFER", {"payment_method": "WIRE"}, LATER)
    with pytest.raises(ConstraintError):
        dml.update(tx, "invoices", F.col("status") == "UNPAID", {"client_id": F.lit(9)}, LATER)
    row = [("2", datetime.date(2024, 1, 1), 1, 1)]
    put(tx, "invoices", row, "invoice_no string, invoice_date date, seller_id long, client_id long")
    with pytest.raises(ConstraintError):
        dml.update(tx, "invoices", F.col("invoice_no") == "2", {"invoice_no": "15686725"}, LATER)
    with pytest.raises(ConstraintError):
        dml.update(tx, "invoices", F.lit(True), {"invoice_no": "same"}, LATER)
    dml.update(tx, "invoices", F.col("invoice_no") == "2", {"invoice_no": "2"}, LATER)
    assert sorted(r[0] for r in tx.read("invoices").select("invoice_no").collect()) == ["15686725", "2"]


def test_restrict_then_cascade(store):
    tx = store.begin()
    with pytest.raises(ConstraintError):
        dml.delete(tx, "products", F.col("product_id") == 1)
    assert tx.read("products").count() == 3
    dml.delete(tx, "invoices", F.col("invoice_no") == "15686725")
    assert [tx.read(t).count() for t in ("invoices", "invoice_items", "payments")] == [0, 0, 0]
    dml.delete(tx, "products", F.col("product_id") == 1)
    assert sorted(r["product_id"] for r in tx.read("products").collect()) == [2, 3]
    assert tx.read("sellers").count() == 1


def test_deleting_a_client_takes_invoices_items_and_payments_along(store):
    tx = store.begin()
    dml.delete(tx, "clients", F.col("client_id") == 1)
    counts = {t: tx.read(t).count() for t in ("clients", "invoices", "invoice_items", "payments", "products", "sellers")}
    assert counts == {"clients": 0, "invoices": 0, "invoice_items": 0, "payments": 0, "products": 3, "sellers": 1}


def test_null_condition_deletes_nothing(store):
    tx = store.begin()
    dml.delete(tx, "invoice_items", F.col("item_net_worth") > 0)
    assert tx.read("invoice_items").count() == 3


@pytest.mark.parametrize(
    "table, row, schema",
    [
        ("clients", ("n", "a", "222-22-2222"), "client_name string, client_address string, client_tax_id string"),
        ("clients", (None, "a", "t"), "client_name string, client_address string, client_tax_id string"),
        ("clients", ("n", "a", "t" * 31), "client_name string, client_address string, client_tax_id string"),
        ("payments", (1, "CASH", D("0")), "invoice_id long, payment_method string, amount decimal(14,2)"),
        ("payments", (1, "WIRE", D("1")), "invoice_id long, payment_method string, amount decimal(14,2)"),
        ("payments", (99, "CASH", D("1")), "invoice_id long, payment_method string, amount decimal(14,2)"),
        ("payments", (1, "CASH", D("1e13")), "invoice_id long, payment_method string, amount decimal(20,2)"),
        ("invoice_items", (1, 1, D("-1"), D("1")), "invoice_id long, product_id long, item_qty decimal(10,2), item_net_price decimal(12,2)"),
    ],
)
def test_insert_enforces_rules(store, table, row, schema):
    with pytest.raises(ConstraintError):
        put(store.begin(), table, [row], schema)


def test_null_payment_method_passes(store):
    tx = store.begin()
    put(tx, "payments", [(1, None, D("1"))], "invoice_id long, payment_method string, amount decimal(14,2)")
    assert sorted(r["payment_id"] for r in tx.read("payments").collect()) == [1, 2]


def test_given_null_is_no_default(spark):
    given = spark.createDataFrame([("1", None)], "invoice_no string, status string")
    row = dml.with_defaults(given, INVOICES, NOW).first()
    assert row["status"] is None and row["total_vat"] == D("0.00")


def test_violations_cover_all_rules(store):
    found = quality.violations(INVOICE_ITEMS, store.read("invoice_items"), {t: store.read(t) for t in ("invoices", "products")})
    assert set(found) == {"rows", "unique item_id", "reference invoice_id", "reference product_id"}
    assert all(df.count() == 0 for df in found.values())
    assert quality.violations(PAYMENTS, store.read("payments"), {"invoices": store.read("invoices").where("false")})[
        "reference invoice_id"
    ].count() == 1


def test_key_updates_are_checked(spark, store):
    tx = store.begin()
    with pytest.raises(ConstraintError):  # invoices name seller 1
        dml.update(tx, "sellers", F.col("seller_id") == 1, {"seller_id": F.lit(2)}, LATER)
    with pytest.raises(ConstraintError):  # product 2 exists
        dml.update(tx, "products", F.col("product_id") == 1, {"product_id": F.lit(2)}, LATER)
    put(tx, "products", [("loose", D("1"))], "product_name string, unit_price decimal(12,2)")
    dml.update(tx, "products", F.col("product_name") == "loose", {"product_id": F.lit(90)}, LATER)
    assert sorted(r[0] for r in tx.read("products").select("product_id").collect()) == [1, 2, 3, 90]
    assert tx.high_key("products") == 90


def test_new_client_reaches_the_dimension_first(store, spark, tmp_path):
    """The manual check: a demo client is inserted, a cycle later it is the newest."""
    star = open_star(spark, str(tmp_path / "star"))
    init_star(star)
    init_marks(star)
    run_cycle(Load(star, store), LATER, retries=0)
    tx = store.begin()
    client = [("Demo Client", "Test Address", "TAX-001", "IBAN-DEMO")]
    put(tx, "clients", client, "client_name string, client_address string, client_tax_id string, iban string", LATER)
    tx.commit()
    run_cycle(Load(star, store), datetime.datetime(2024, 5, 3), retries=0)
    newest, sample = reads.verify_star(star)
    assert [(r["client_key"], r["client_name"]) for r in newest.collect()] == [(2, "Demo Client"), (1, "Smith Stores")]
    assert sample.count() == 1
