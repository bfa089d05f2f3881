import datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tallyfold.operators.incremental import get_mark
from tallyfold.plans import cycle
from tallyfold.plans.cycle import Load, init_marks, init_star, open_star, run_cycle
from tallyfold.schemas import SOURCE_TABLES
from tallyfold.streaming.continuous import run_stream


def day(n, hour=0):
    return datetime.datetime(2024, 1, n, hour)


def party(i, name="n", at=1, singular="client"):
    return (i, name, "addr", f"tax{i}", None, day(1), day(at))


def product(i, at=1, name="p", desc="d", price="1.00"):
    return (i, name, desc, D(price), D("10.00"), day(1), day(at))


def invoice(i, seller=1, client=1, at=1, date=datetime.date(2024, 1, 1), gross="11.00", status="UNPAID", net="10.00"):
    return (i, f"no{i}", date, seller, client, D(net), D("1.00"), D(gross), status, day(1), day(at))


def item(i, inv=1, prod=1, at=1):
    return (i, inv, prod, D("1.00"), D("1.00"), None, D("10.00"), None, day(at))


def payment(i, inv=1, at=1, date=datetime.date(2024, 2, 2)):
    return (i, inv, date, "CASH", f"r{i}", D("5.00"), None, day(at))


@pytest.fixture
def star(spark, root):
    store = open_star(spark, root, block_rows=4)
    init_star(store)
    init_marks(store)
    return store


def load(star, **options):
    """A load over literal rows; returns it and the dict of rows to change."""
    rows = {
        "clients": [party(1)],
        "sellers": [party(1)],
        "products": [product(1)],
        "invoices": [invoice(1)],
        "invoice_items": [item(1)],
        "payments": [payment(1)],
    }
    return Load(star, lambda t: star.spark.createDataFrame(rows[t], SOURCE_TABLES[t].schema), **options), rows


def column(star, table, *names):
    return sorted(tuple(r) for r in star.read(table).select(*names).collect())


def test_first_cycle(star):
    job, _ = load(star)
    counts = run_cycle(job, day(10), retries=0)
    assert counts == dict.fromkeys(
        ["dim_client", "dim_seller", "dim_product", "fact_invoice", "fact_invoice_item", "fact_payment"], 1
    )
    assert column(star, "dim_date", "date_key") == [(20240101,), (20240202,)]
    assert {r[1] for r in star.read("etl_watermarks").collect()} == {day(10)}
    assert column(star, "fact_payment", "payment_key", "payment_date_key", "payment_id") == [(1, 20240202, 1)]


def test_marks_move_even_when_nothing_is_loaded(star):
    job, rows = load(star)
    for name in rows:
        rows[name] = []
    run_cycle(job, day(10), retries=0)
    assert {r[1] for r in star.read("etl_watermarks").collect()} == {day(10)}
    assert star.read("dim_date").count() == 0


def test_filter_includes_the_mark_and_misses_late_rows(star):
    job, rows = load(star)
    run_cycle(job, day(10), retries=0)
    rows["clients"] = [party(2, at=10), party(3, at=9)]
    run_cycle(job, day(11), retries=0)
    assert column(star, "dim_client", "client_id") == [(1,), (2,)]
    # An overlap catches the late row.
    job.overlap = datetime.timedelta(days=5)
    run_cycle(job, day(12), retries=0)
    assert column(star, "dim_client", "client_key", "client_id") == [(1, 1), (2, 2), (3, 3)]


def test_frozen_invoice_columns(star):
    job, rows = load(star)
    run_cycle(job, day(10), retries=0)
    rows["sellers"].append(party(2))
    rows["invoices"] = [invoice(1, at=20, gross="99.00", status="PAID", net="90.00", date=datetime.date(2025, 5, 5))]
    run_cycle(job, day(21), retries=0)
    names = ("invoice_key", "total_net", "total_gross", "status", "invoice_date_key", "updated_at")
    assert column(star, "fact_invoice", *names) == [(1, D("10.00"), D("99.00"), "PAID", 20240101, day(20))]
    # The date of the batch row was asked for, so it exists although the fact keeps the old one.
    assert (20250505,) in column(star, "dim_date", "date_key")


def test_unresolved_rows_are_lost_but_reported(star):
    seen = {}
    job, rows = load(star, on_unresolved=lambda name, df: seen.setdefault(name, []).extend(df.collect()))
    rows["invoices"] = [invoice(1), invoice(2, seller=9, date=datetime.date(2024, 7, 7))]
    rows["invoice_items"] = [item(1), item(2, prod=9)]
    run_cycle(job, day(10), retries=0)
    assert column(star, "fact_invoice", "invoice_id") == [(1,)]
    assert [(r["invoice_id"], r["seller_missing"], r["client_missing"]) for r in seen["invoices"]] == [(2, True, False)]
    assert [r["item_id"] for r in seen["invoice_items"]] == [2]
    # Dates come only from invoices that were resolved.
    assert (20240707,) not in column(star, "dim_date", "date_key")
    # The party arrives later; the mark has passed the invoice.
    rows["sellers"].append(party(9, at=11))
    run_cycle(job, day(12), retries=0)
    assert column(star, "fact_invoice", "invoice_id") == [(1,)]


def test_orphan_items_and_payments_are_legal(star):
    job, rows = load(star)
    rows["invoices"] = []
    run_cycle(job, day(10), retries=0)
    assert star.read("fact_invoice").count() == 0
    assert column(star, "fact_invoice_item", "invoice_id") == [(1,)]
    assert column(star, "fact_payment", "invoice_id") == [(1,)]


def test_append_mode_duplicates_boundary_rows(spark, root):
    star = open_star(spark, root, "append")
    init_star(star)
    init_marks(star)
    job, rows = load(star)
    rows["invoice_items"] = [item(1, at=10), item(2, at=9)]
    for n in (10, 11):
        run_cycle(job, day(n), retries=0)
    assert column(star, "fact_invoice_item", "invoice_item_key", "created_at") == [(1, day(10)), (2, day(9)), (3, day(10))]
    assert "item_id" not in star.read("fact_invoice_item").columns


def test_idempotent_mode_stores_each_row_once(star):
    job, rows = load(star)
    rows["invoice_items"] = [item(1, at=10), item(2, at=9)]
    for n in (10, 11, 5):
        run_cycle(job, day(n), retries=0)
    rows["invoice_items"].append(item(3, at=7))
    run_cycle(job, day(20), retries=0)
    assert column(star, "fact_invoice_item", "invoice_item_key", "item_id") == [(1, 1), (2, 2), (3, 3)]


def test_source_deletes_and_item_updates_do_not_arrive(star):
    job, rows = load(star)
    run_cycle(job, day(10), retries=0)
    rows["invoice_items"] = [item(1, prod=1)[:3] + (D("7.00"),) + item(1)[4:]]
    rows["clients"] = []
    run_cycle(job, day(11), retries=0)
    assert column(star, "fact_invoice_item", "qty") == [(D("1.00"),)]
    assert star.read("dim_client").count() == 1


def test_missing_mark_loads_nothing(star):
    tx = star.begin()
    tx.replace("etl_watermarks", tx.read("etl_watermarks").where("stream_name NOT IN ('clients', 'payments')").coalesce(1))
    tx.commit()
    job, _ = load(star)
    run_cycle(job, day(10), retries=0)
    assert star.read("dim_client").count() == 0
    assert star.read("fact_payment").count() == 0
    # Without its client the invoice is unresolved; a missing mark is not created.
    assert star.read("fact_invoice").count() == 0
    assert star.read("etl_watermarks").count() == 4


def test_increments_give_the_same_dimension_as_one_load(spark, tmp_path):
    def run(steps):
        star = open_star(spark, str(tmp_path / f"s{len(steps)}"), block_rows=4)
        init_star(star)
        init_marks(star)
        job, rows = load(star)
        for n, clients in enumerate(steps):
            rows["clients"] = clients
            cycle.load_dimensions(job, day(10 + n))
        return column(star, "dim_client", "client_id", "client_name", "updated_at")

    every = [party(i, f"n{i}", at=20) for i in range(1, 13)]
    assert run([every]) == run([every[:3], every[3:7], every[7:]])


def test_failed_group_publishes_nothing_and_is_retried(star, monkeypatch):
    job, rows = load(star)
    calls = []
    real = cycle.load_fact_payment

    def flaky(job, tx):
        calls.append(1)
        if len(calls) == 1:
            assert tx.read("fact_invoice").count() == 1
            raise RuntimeError("lost")
        real(job, tx)

    monkeypatch.setattr(cycle, "load_fact_payment", flaky)
    with pytest.raises(RuntimeError):
        run_cycle(job, day(10), retries=0)
    assert star.read("fact_invoice").count() == 0
    assert get_mark(star.read("etl_watermarks"), "clients") == day(10)
    assert get_mark(star.read("etl_watermarks"), "invoices").year == 1900
    calls.clear()
    run_cycle(job, day(10), retries=1, retry_delay=0)
    assert len(calls) == 2
    assert column(star, "fact_invoice", "invoice_key") == [(1,)]


def test_mark_is_a_pushed_literal(spark, star, tmp_path):
    path = str(tmp_path / "clients")
    spark.createDataFrame([party(1)], SOURCE_TABLES["clients"].schema).write.parquet(path)
    from tallyfold.operators.incremental import incremental
    from tallyfold.sources.tables import read_source

    df = incremental(read_source(spark, str(tmp_path), "clients"), star.read("etl_watermarks"), "clients", "updated_at")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(updated_at,1900-01-01T00:00)" in plan
    assert "NestedLoop" not in plan


def test_hot_seller_is_split(spark):
    """Most invoices belong to one seller; with both sides too large to broadcast
    the join is split by adaptive execution."""
    from tallyfold.operators.star import resolve_invoice_keys

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        invoices = spark.range(0, 60_000, 1, 8).selectExpr(
            "id AS invoice_id", "IF(id % 10 < 7, 1, id % 500) AS seller_id", "id % 900 AS client_id"
        )
        sellers = spark.range(500).selectExpr("id AS seller_id", "id + 1 AS seller_key")
        clients = spark.range(900).selectExpr("id AS client_id", "id + 1 AS client_key")
        joined = resolve_invoice_keys(invoices, sellers, clients)
        assert len(joined.collect()) == 60_000
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_stream(spark, star, tmp_path):
    folders = {name: str(tmp_path / "in" / name) for name in SOURCE_TABLES}
    _, rows = load(star)

    def land(name, new):
        spark.createDataFrame(new, SOURCE_TABLES[name].schema).coalesce(1).write.mode("append").parquet(folders[name])

    def go(n):
        run = run_stream(
            spark,
            star,
            folders,
            str(tmp_path / "state"),
            interval=None,
            retries=0,
            clock=lambda: day(n),
        )
        run.awaitTermination()

    for name, new in rows.items():
        land(name, new)
    go(10)
    assert column(star, "fact_invoice_item", "item_id") == [(1,)]
    version = star.latest()
    go(11)  # no new file, no batch
    assert star.latest() == version
    # Two versions of one client land together; the newer one stays.
    land("clients", [party(1, "middle", at=11), party(2, "late", at=9)])
    land("clients", [party(1, "newest", at=12)])
    land("invoice_items", [item(1), item(2, at=12)])
    go(13)
    assert column(star, "dim_client", "client_key", "client_name") == [(1, "newest"), (2, "late")]
    assert column(star, "fact_invoice_item", "invoice_item_key", "item_id") == [(1, 1), (2, 2)]
    assert star.read("etl_watermarks").where(F.col("last_loaded_ts") == day(13)).count() == 6
    # An older version does not undo a newer one; a replayed row is stored once, and one stamped long before the mark is stored.
    land("clients", [party(1, "older", at=10)])
    land("invoice_items", [item(2, at=12), item(3, at=2)])
    go(14)
    assert column(star, "dim_client", "client_key", "client_name") == [(1, "newest"), (2, "late")]
    assert column(star, "fact_invoice_item", "invoice_item_key", "item_id") == [(1, 1), (2, 2), (3, 3)]


def test_source_that_grows_while_it_is_read(spark, star):
    """A source with one more row on each read: numbers stay unique and nothing that was counted is lost."""
    _, rows = load(star)

    def source(name):
        if name != "invoice_items":
            return spark.createDataFrame(rows[name], SOURCE_TABLES[name].schema)

        extra = F.udf(lambda i: i, "long").asNondeterministic()
        return spark.createDataFrame([item(i) for i in range(1, 40)], SOURCE_TABLES[name].schema).where(
            (extra("item_id") < 30) | (F.rand() < 0.5)
        )

    run_cycle(Load(star, source), day(10), retries=0)
    keys = sorted(r[0] for r in star.read("fact_invoice_item").select("invoice_item_key").collect())
    assert keys == list(range(1, len(keys) + 1)) and len(keys) >= 29
