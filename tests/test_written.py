"""What reaches the disk: files for each block, filters as small as their rows, packed texts, shuffle files."""

import json
from pathlib import Path

from pyspark.sql import functions as F

from tallyfold.functions.calendar import stamp
from tallyfold.operators import dml, merge, quality
from tallyfold.plans import fixtures, ingest
from tallyfold.plans.cycle import open_star
from tallyfold.plans.ingest import open_source
from tallyfold.queries import documents
from tallyfold.schemas import SOURCE_TABLES
from tallyfold.session import MEASURED_JOIN, PACKED_JOIN, WRITING, scratch, shared_dir, side_by_side, stage, writing
from tallyfold.sources.invoice_lines import number_lines, read_invoice_lines
from tallyfold.sources.store import Transaction

NOW = "2024-05-01 10:00:00"
SCATTERED = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
}


class settings:
    def __init__(self, spark, values):
        self.spark, self.values = spark, values

    def __enter__(self):
        self.before = {k: self.spark.conf.get(k, None) for k in self.values}
        for k, v in self.values.items():
            self.spark.conf.set(k, v)

    def __exit__(self, *_):
        for k, v in self.before.items():
            self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)


def live_files(store, table):
    """Parquet files of each live folder of a table."""
    parts = store.version()["tables"][table]["parts"]
    return [len(list(Path(f"{store.root}/{p['path']}").glob("*.parquet"))) for p in parts]


def rows_of(spark, table, n, **values):
    ids = spark.range(1, n + 1)
    return ids.select(
        *(values.get(c.name, F.concat(F.lit("t"), "id") if c.type.typeName() == "string" else F.col("id")).cast(c.type).alias(c.name)
          if c.type.typeName() not in ("timestamp_ntz", "date") else stamp(NOW).cast(c.type).alias(c.name)
          for c in SOURCE_TABLES[table].columns)
    )


def sold(spark, root, invoices=400):
    """Ten sellers and clients, their invoices in blocks of 16 ids, and an item and a payment for each."""
    store = open_source(spark, root, 16, buckets=4)
    tx = store.begin()
    party = F.col("id") % 10 + 1
    method = F.lit("CASH")
    for name, n, values in (
        ("sellers", 10, {}),
        ("clients", 10, {}),
        ("products", 10, {}),
        ("invoices", invoices, {"seller_id": party, "client_id": party}),
        ("invoice_items", invoices, {"product_id": party}),
        ("payments", invoices, {"payment_method": method}),
    ):
        dml.insert(tx, name, rows_of(spark, name, n, **values), NOW, check=False)
    tx.commit()
    return store


def ids(store, table):
    return {r[0] for r in store.read(table).select(store.tables[table].key).collect()}


def test_a_filter_is_as_small_as_its_rows(spark, root):
    store = sold(spark, root)
    sizes = [f.stat().st_size for f in Path(f"{root}/invoices").rglob("*.parquet")]
    assert len(sizes) >= 25 and max(sizes) < 100_000


def test_deletes_write_one_file_for_each_block(spark, tmp_path, monkeypatch):
    want = {i for i in range(1, 401) if i % 10 + 1 != 7}
    for few in (0, 100, 1 << 22):  # all by joins; items by their few sellers' invoices; all by their own keys
        store = sold(spark, str(tmp_path / f"few{few}"))
        monkeypatch.setattr(dml, "FEW_KEYS", few)
        with settings(spark, SCATTERED):
            tx = store.begin()
            dml.delete(tx, "sellers", F.col("seller_id") == 7)
            tx.commit()
        for table in ("invoices", "invoice_items", "payments"):
            assert ids(store, table) == want, (few, table)
        assert set(live_files(store, "invoices")) == {1}
        assert store.read("payment_totals").count() == len(want)


def test_many_paid_invoices_are_written_as_one_file_for_each_block(spark, root, monkeypatch):
    store = sold(spark, root)
    monkeypatch.setattr(ingest, "BROADCAST_BYTES", 0)
    with settings(spark, SCATTERED):
        tx = store.begin()
        ingest.refresh_status(tx, spark.range(1, 401).select(F.col("id").alias("invoice_id")), NOW)
        tx.commit()
    assert set(live_files(store, "invoices")) == {1}
    assert {r[0] for r in store.read("invoices").select("status").distinct().collect()} == {"PAID"}


def test_large_upserts_write_one_file_for_each_block(spark, root, monkeypatch):
    monkeypatch.setattr(merge, "BROADCAST_BYTES", 0)
    store = open_star(spark, root, block_rows=16)
    batch = spark.range(1, 401).select(
        F.col("id").alias("client_id"),
        F.concat(F.lit("c"), "id").alias("client_name"),
        F.lit("a").alias("client_addr"),
        F.concat(F.lit("t"), "id").alias("client_tax_id"),
        F.lit(None).cast("string").alias("iban"),
        stamp(NOW).alias("updated_at"),
    )
    with settings(spark, SCATTERED):
        for _ in range(2):
            tx = store.begin()
            merge.upsert(tx, "dim_client", stage(batch))
            tx.commit()
    assert set(live_files(store, "dim_client")) == {1}
    assert store.read("dim_client").count() == 400


def test_documents_are_packed_and_in_order(spark, tmp_path):
    folder = str(tmp_path)
    day = stamp("2024-01-02 00:00:00").cast("timestamp")
    n = F.col("id")
    spark.range(60).select(
        (59 - n).alias("l_orderkey"), (n % 3).alias("l_partkey"), (n % 2).alias("l_suppkey"), n.cast("int").alias("l_linenumber"),
        n.cast("double").alias("l_quantity"), n.cast("double").alias("l_extendedprice"), F.lit(0.1).alias("l_discount"),
        F.lit(0.05).alias("l_tax"), F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"), day.alias("l_shipdate"),
    ).write.parquet(f"{folder}/lineitem.parquet")
    spark.range(60).select(
        n.alias("o_orderkey"), (n % 5).alias("o_custkey"), F.lit("O").alias("o_orderstatus"), n.cast("double").alias("o_totalprice"),
        day.alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"),
    ).write.parquet(f"{folder}/orders.parquet")
    spark.range(3).select(n.alias("p_partkey"), F.lit("p").alias("p_name")).write.parquet(f"{folder}/part.parquet")
    spark.range(2).select(n.alias("s_suppkey"), F.lit("s").alias("s_name")).write.parquet(f"{folder}/supplier.parquet")
    spark.range(5).select(n.alias("c_custkey"), F.lit("c").alias("c_name")).write.parquet(f"{folder}/customer.parquet")
    path = documents.written(spark, folder)
    assert list(Path(path).glob("*.gz")) and not list(Path(path).glob("*.txt"))
    found = [r[0] for r in spark.read.text(path).collect()]
    plain = documents.documents(spark, folder).orderBy("l_orderkey").collect()
    assert found == [r["value"] for r in plain] and len(found) == 60


def test_documents_are_sorted_when_joins_have_left_the_disk(spark, tmp_path, monkeypatch):
    given = spark.createDataFrame([(3, 1), (1, 1), (2, 1)], "l_orderkey long, l_partkey long")
    given = given.select("*", *(F.lit(1).alias(c) for c in fixtures.LINE_ORDER if c not in given.columns))
    tables = {
        "lineitem": given.withColumns({"l_shipdate": stamp(NOW), "l_returnflag": F.lit("N"), "l_linestatus": F.lit("O")}),
        "orders": spark.range(1, 4).selectExpr("id o_orderkey", "1 o_custkey", "timestamp '2024-01-02' o_orderdate", "'x' o_orderpriority"),
        "customer": spark.sql("SELECT 1 c_custkey, 'c' c_name"),
        "part": spark.sql("SELECT 1 p_partkey, 'p' p_name"),
        "supplier": spark.sql("SELECT 1 s_suppkey, 's' s_name"),
    }
    monkeypatch.setattr(fixtures, "raw", lambda spark, folder, name: tables[name])
    with settings(spark, SCATTERED):
        found = documents.documents(spark, "", ordered=True)
        assert "Join" not in plan(found) and found.inputFiles()
        assert [r[0] for r in found.select("l_orderkey").collect()] == [1, 2, 3]
        path = documents.written(spark, "")
    assert sum(1 for _ in spark.read.text(path).collect()) == 3
    assert len(list(Path(shared_dir(spark)).glob("joined-*"))) == 1  # that of `found`; the other was removed


def test_ingest_writes_items_when_its_lines_are_gone(spark, root, tmp_path, monkeypatch):
    def document(no, names):
        header = {"seller": "s", "seller_tax_id": "S", "client": "c", "client_tax_id": "C", "iban": "I", "invoice_no": no, "invoice_date": "1/5/2021"}
        items = [{"item_desc": n, "item_qty": "x" if n == "bad" else "1,00", "item_net_price": "1,00", "item_vat": "8%"} for n in names]
        return {"gt_parse": {"header": header, "items": items, "summary": {k: "$ 1.00" for k in ("total_net_worth", "total_vat", "total_gross_worth")}}}

    given = [document("1", ["a", "bad", "b"]), document("2", []), document("1", ["b"]), document("3", ["bad"]), document("2", ["c", "a"])]
    path = tmp_path / "lines.txt"
    path.write_text("\n".join(map(json.dumps, given)) + "\n")
    append, there = Transaction.append, {}

    def seen(tx, name, df):
        there[name] = [f for f in Path(shared_dir(spark)).glob("job-*/lines-*") if f.is_dir()]
        return append(tx, name, df)

    before = set(Path(shared_dir(spark)).glob("job-*/lines-*"))
    monkeypatch.setattr(Transaction, "append", seen)
    store = open_source(spark, root, 16, buckets=2)
    report = ingest.ingest_invoices(spark, str(path), store, "item", NOW)
    assert set(there["sellers"]) - before and not set(there["invoice_items"]) - before
    assert (report.lines, report.accepted) == (5, 5)
    names = store.read("products").select("product_id", "product_name")
    found = store.read("invoice_items").join(names, "product_id").orderBy("item_id").select("item_id", "invoice_id", "product_name")
    assert [tuple(r) for r in found.collect()] == [(1, 1, "a"), (2, 1, "b"), (3, 1, "b"), (4, 2, "c"), (5, 2, "a")]


def test_many_documents_are_written_slice_by_slice_and_in_order(spark, monkeypatch):
    given = spark.range(40).select(((39 - F.col("id")) % 13).alias("l_orderkey"), F.lit(1).alias("l_partkey"), F.col("id").cast("int").alias("l_linenumber"))
    given = given.select("*", *(F.lit(1).alias(c) for c in fixtures.LINE_ORDER if c not in given.columns))
    tables = {
        "lineitem": given.withColumns({"l_shipdate": stamp(NOW), "l_returnflag": F.lit("N"), "l_linestatus": F.lit("O")}),
        "orders": spark.range(12).selectExpr("id o_orderkey", "1 o_custkey", "timestamp '2024-01-02' o_orderdate", "'x' o_orderpriority"),
        "customer": spark.sql("SELECT 1 c_custkey, 'c' c_name"),
        "part": spark.sql("SELECT 1 p_partkey, 'p' p_name"),
        "supplier": spark.sql("SELECT 1 s_suppkey, 's' s_name"),
    }
    monkeypatch.setattr(fixtures, "raw", lambda spark, folder, name: tables[name])
    monkeypatch.setattr(documents, "SLICE_ROWS", 10)
    staged = set(Path(shared_dir(spark)).glob("joined-*"))
    path = documents.written(spark, "")
    assert len(list(Path(path).glob("slice=*"))) == 4 and set(Path(shared_dir(spark)).glob("joined-*")) == staged
    lines = number_lines(stage(read_invoice_lines(spark, path))).orderBy("line_no").select("line").collect()
    plain = documents.documents(spark, "").orderBy(*fixtures.LINE_ORDER).collect()
    assert [r[0] for r in lines] == [r["value"] for r in plain] and len(lines) == 37


def test_ingest_needs_no_file_once_its_lines_are_staged(spark, root, tmp_path, monkeypatch):
    header = {"seller": "s", "seller_tax_id": "S", "client": "c", "client_tax_id": "C", "iban": "I", "invoice_date": "1/5/2021"}
    items = [{"item_desc": n, "item_qty": "1,00", "item_net_price": "1,00", "item_vat": "8%"} for n in "ab"]
    summary = {k: "$ 1.00" for k in ("total_net_worth", "total_vat", "total_gross_worth")}
    given = [{"gt_parse": {"header": {**header, "invoice_no": str(i)}, "items": items, "summary": summary}} for i in range(20)]
    path = tmp_path / "lines.txt"
    path.write_text("\n".join(map(json.dumps, given)) + "\n")
    monkeypatch.setattr(ingest, "TURN_ROWS", 10)
    append, appended = Transaction.append, []

    def seen(tx, name, df):
        appended.append((name, path.exists()))
        return append(tx, name, df)

    monkeypatch.setattr(Transaction, "append", seen)
    store = open_source(spark, root, 16, buckets=8)
    ingest.ingest_invoices(spark, str(path), store, "line", NOW, on_read=path.unlink)
    # The items come in turns, each of other blocks, so that a block is still one folder.
    assert [name for name, _ in appended].count("invoice_items") == 4 and not any(there for _, there in appended)
    blocks = [p["block"] for p in store.version()["tables"]["invoice_items"]["parts"]]
    assert len(blocks) == len(set(blocks))
    found = store.read("invoice_items").orderBy("item_id").select("item_id", "invoice_id", "product_id").collect()
    assert [tuple(r) for r in found] == [(2 * i + j, i + 1, j) for i in range(20) for j in (1, 2)]


def test_first_rows_of_few_keys_are_not_shuffled(spark):
    rows = spark.range(1000).select((F.col("id") % 3).cast("string").alias("k"), F.col("id").alias("o"))
    found = merge.first_rows(rows, "k", "o", staged=True)
    assert "Exchange hashpartitioning" not in plan(found) and {r["o"] for r in found.collect()} == {0, 1, 2}


def test_settings_of_writes_end_with_the_last_of_them(spark):
    before = {k: spark.conf.get(k, None) for k in WRITING}

    def write():
        with writing(spark):
            stage(spark.range(3))
            assert {k: spark.conf.get(k) for k in WRITING} == WRITING

    side_by_side(write, write, write)
    assert {k: spark.conf.get(k, None) for k in WRITING} == before


def test_tasks_of_writes_are_small(spark):
    """A task sorts many times what it reads: at Spark's own sizes, more than a core has. Smaller ones stay."""
    sizes = {"spark.sql.files.maxPartitionBytes": "128MB", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m"}
    with settings(spark, sizes):
        with writing(spark):
            assert [spark.conf.get(k) for k in sizes] == ["16777216b", "8m"]
        assert {k: spark.conf.get(k) for k in sizes} == sizes


def test_settings_of_writes_hold_in_each_session(spark):
    """A stream runs its batches in a copy of its session, beside the session that the star was opened with."""
    other = spark.newSession()
    before = [{k: s.conf.get(k, None) for k in (*WRITING, PACKED_JOIN)} for s in (spark, other)]
    with writing(spark), writing(other):
        assert [{k: s.conf.get(k) for k in WRITING} for s in (spark, other)] == [WRITING, WRITING]
    assert [{k: s.conf.get(k, None) for k in (*WRITING, PACKED_JOIN)} for s in (spark, other)] == before


def test_ids_that_are_packed_well_are_not_broadcast(spark):
    """A million ids are a few MB as a file, and fifty in a hash table, which the driver would have to build."""
    with settings(spark, {PACKED_JOIN: "10MB"}), scratch(spark):
        ids, few = stage(spark.range(1 << 20).toDF("id")), stage(spark.range(1000).toDF("id"))
        rows = stage(spark.range(1 << 21).select("id", F.lit("x").alias("x")))
        assert "BroadcastHashJoin" not in plan(rows.join(ids, "id")) and "BroadcastHashJoin" in plan(rows.join(few, "id"))
    with settings(spark, {PACKED_JOIN: "-1"}), writing(spark):
        assert {spark.conf.get(k) for k in (PACKED_JOIN, MEASURED_JOIN)} == {"-1"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_an_audit_shuffles_entries_once_and_sorts_nothing(spark):
    rows = {name: rows_of(spark, name, 10) for name in ("sellers", "clients", "invoices", "invoice_items")}
    rows["invoices"] = rows["invoices"].unionByName(rows["invoices"].where("invoice_id = 3").withColumn("seller_id", F.lit(77)))
    found = quality.audit(SOURCE_TABLES, rows)
    # One exchange of all entries, one of what was found.
    assert plan(found).count("Exchange hashpartitioning") == 1 and plan(found).count("Exchange") == 2
    assert "Sort" not in plan(found) and "ObjectHash" not in plan(found)
    assert {tuple(r) for r in found.collect()} == {
        ("invoices", "invoice_id is repeated", "3", 2),
        ("invoices", "invoice_no is repeated", "t3", 2),
        ("invoices", "seller_id refers to no row", "77", 1),
    }


def test_joins_to_the_keys_of_children_sort_each_key_once(spark):
    with settings(spark, SCATTERED):
        parents, children = spark.range(5), spark.range(4000).select((F.col("id") % 2).alias("parent"))
        for found, want in (
            (dml.restrict_blockers(parents, "id", children, "parent"), {0, 1}),
            (dml.without_children(parents, "id", children.select("parent")), {2, 3, 4}),
        ):
            assert {r[0] for r in found.collect()} == want
            assert "HashAggregate" in plan(found)


def test_staged_tables_are_packed(spark, root):
    """With zstd, as stored tables are: staged rows are most of what a job writes."""
    path = stage(spark.range(100).select(F.lit("text").alias("text")), "packed").inputFiles()[0]
    assert path.endswith(".zstd.parquet")


def test_rows_of_single_keys_do_not_move(spark):
    """Only rows that share a key are looked at as a whole; null is a key, too."""

    def pick(rows):
        seen.extend(r.id for r in rows.collect())
        return merge.latest_per_key(rows, "id", "updated_at")

    single = stage(spark.createDataFrame([(1, 5), (2, 7), (None, 1)], "id long, updated_at long"), "single")
    seen = []
    assert merge.one_per_key(single, "id", pick) is single and not seen
    more = spark.createDataFrame([(2, 8), (2, 6), (None, 3)], "id long, updated_at long")
    both = stage(single.unionByName(more), "both")
    whole = {(1, 5), (2, 8), (None, 3)}
    assert {tuple(r) for r in merge.one_per_key(both, "id", pick).collect()} == whole
    assert sorted(seen, key=str) == [2, 2, 2, None, None]
    few, merge.FEW_KEYS = merge.FEW_KEYS, 1
    try:
        assert {tuple(r) for r in merge.one_per_key(both, "id", pick).collect()} == whole
    finally:
        merge.FEW_KEYS = few
    assert len(seen) == 5 + 6
