"""Plans of the queries: no step that gathers a table in one place or pairs all rows."""

import pytest

from tallyfold.operators import keys, star
from tallyfold.plans import fixtures
from tallyfold.plans.cycle import Load, init_marks, init_star, open_star, run_cycle
from tallyfold.queries import QUERIES
from tallyfold.schemas import SOURCE_TABLES
from tallyfold.sources.tables import read_source

FOLDER = "/root/testdata/sf0.001"

# Global counts end in one row, which needs one partition.
GLOBAL = {"peek_invoices"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - GLOBAL))
def test_no_single_partition_and_no_pairing(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "SinglePartition" not in text
    assert "CartesianProduct" not in text
    assert "NestedLoop" not in text
    assert "PythonUDF" not in text and "InPandas" not in text


def test_lookup_reads_two_columns_of_a_dimension(spark, tmp_path):
    from tallyfold.schemas import star_tables

    folders = {}
    for name in ("dim_seller", "dim_client"):
        folders[name] = str(tmp_path / name)
        spark.createDataFrame([], star_tables()[name].schema).write.parquet(folders[name])
    dims = [spark.read.parquet(folders[n]) for n in ("dim_seller", "dim_client")]
    text = plan(star.project_invoice(star.resolve_invoice_keys(fixtures.invoices(spark, FOLDER), *dims)))
    assert "ReadSchema: struct<seller_key:bigint,seller_id:bigint>" in text
    assert "ReadSchema: struct<client_key:bigint,client_id:bigint>" in text
    assert "BroadcastHashJoin" in text


def test_large_dimensions_are_joined_by_shuffle(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
        items = fixtures.invoice_items(spark, FOLDER, numbered=False)
        products = fixtures.products(spark, FOLDER).withColumnRenamed("vat_rate", "product_key")
        text = plan(star.resolve_item_keys(items, products))
        assert "SortMergeJoin" in text and "Broadcast" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_distinct_dates_combine_before_the_shuffle(spark):
    dates = fixtures.raw(spark, FOLDER, "lineitem").selectExpr("CAST(l_shipdate AS DATE) AS d")
    text = plan(star.missing_dates(fixtures.raw(spark, FOLDER, "orders").selectExpr("1 AS date_key"), dates))
    assert text.count("HashAggregate(keys=[d") >= 2


def test_numbering_joins_offsets_by_broadcast_and_keeps_groups_apart(spark):
    ids = fixtures.raw(spark, FOLDER, "lineitem").selectExpr("l_orderkey * 7 AS id", "l_linenumber AS pos")
    text = plan(keys.assign_keys(ids, "id", 0, "k", ("pos",))[0])
    assert text.count("Exchange hashpartitioning") == 1
    assert "BroadcastHashJoin" in text


def test_large_upsert_shuffles_each_side_once(spark):
    """Both sides are partitioned by block; join and write need nothing more."""
    from tallyfold.operators.merge import merged
    from tallyfold.sources.store import BLOCK

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        rows = fixtures.products(spark, FOLDER).select("product_id", "product_name", "unit_price")
        sides = [rows.selectExpr("*", f"product_id div 16 AS {BLOCK}").repartition(BLOCK) for _ in range(2)]
        text = plan(merged(*sides, "product_id", ("unit_price",), [BLOCK, "product_id"]))
        assert text.count("Exchange ") == 2
        assert "SortMergeJoin" in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_small_upsert_does_not_shuffle_the_table(spark):
    from pyspark.sql import functions as F

    from tallyfold.operators.merge import known_rows, merged

    rows = fixtures.products(spark, FOLDER).select("product_id", "product_name", "unit_price")
    few = F.broadcast(rows.where("unit_price > 1000"))
    for df in (merged(rows, few, "product_id", ("unit_price",)), known_rows(rows, few, "product_id")):
        assert "Exchange hashpartitioning" not in plan(df)


def executed(spark, job):
    """Final plans of all that `job` runs, writes included, as the session itself keeps them."""
    store = spark._jsparkSession.sharedState().statusStore()

    def all_plans():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        found = store.executionsList()
        return {found.apply(i).executionId(): found.apply(i).physicalPlanDescription() for i in range(found.size())}

    before = set(all_plans())
    job()
    return [p for i, p in sorted(all_plans().items()) if i not in before]


@pytest.fixture(scope="module")
def cycle_plans(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("cycle")
    for name in SOURCE_TABLES:
        fixtures.READERS[name](spark, FOLDER).write.parquet(str(root / "in" / name))
    folder = open_star(spark, str(root / "star"), block_rows=1 << 15)
    init_star(folder)
    init_marks(folder)
    load = Load(folder, lambda name: read_source(spark, str(root / "in"), name))
    return [executed(spark, lambda: run_cycle(load, f"2024-0{n}-01 00:00:00", retries=0)) for n in (1, 2)]


def test_a_cycle_reads_each_source_once(cycle_plans):
    """Counts, key ranges, merges and appends work on the staged batch."""
    for plans in cycle_plans:
        for name in SOURCE_TABLES:
            assert sum(f"/in/{name}]" in p for p in plans) == 1, name


def test_a_cycle_pairs_and_gathers_no_rows(cycle_plans):
    """New days and the six marks are bounded by the calendar and go to one file; no other write is gathered."""
    for text in (p for plans in cycle_plans for p in plans):
        assert "CartesianProduct" not in text and "NestedLoop" not in text
        if "InsertIntoHadoopFsRelationCommand" in text and "day_name" not in text and "etl_watermarks" not in text:
            assert "SinglePartition" not in text


def test_audit_scans_each_table_once(spark, tmp_path):
    from tallyfold.operators import quality

    rows = {}
    for name, table in SOURCE_TABLES.items():
        spark.createDataFrame([], table.schema).write.parquet(str(tmp_path / name))
        rows[name] = spark.read.parquet(str(tmp_path / name))
    text = plan(quality.audit(SOURCE_TABLES, rows))
    assert text.count("FileScan parquet") == len(SOURCE_TABLES)
    assert "Join" not in text and text.count("Exchange") == 2


def test_audit_rules(spark):
    """Several rules broken by one row, NULLs, a parent that is not among the tables, nothing at all."""
    from tallyfold.operators import quality

    names = "payment_id long, invoice_id long, payment_date date, payment_method string, payment_reference string, "
    names += "amount decimal(20,2), remarks string, created_at timestamp_ntz"
    long = "r" * 101
    payments = spark.sql(
        f"""SELECT * FROM VALUES (1L, 7L, DATE'2024-01-01', 'WIRE', '{long}', -1.00, NULL, NULL),
            (1L, 7L, NULL, NULL, NULL, 1.00, NULL, NULL), (NULL, NULL, DATE'2024-01-01', 'CASH', NULL, 1000000000000000.00, NULL, NULL)
            AS t({", ".join(c.split()[0] for c in names.split(", "))})"""
    )
    found = {tuple(r) for r in quality.audit(SOURCE_TABLES, {"payments": payments}).collect()}
    broken = {
        ("payments", "payment_id is repeated", "1", 2), ("payments", "payment_date is null", "1", 1),
        ("payments", "payment_method_known fails", "1", 1), ("payments", "payment_reference is too long", "1", 1),
        ("payments", "amount_positive fails", "1", 1), ("payments", "payment_id is null", None, 1),
        ("payments", "invoice_id is null", None, 1), ("payments", "amount is out of range", None, 1),
    }
    assert found == broken
    invoices = spark.createDataFrame([], SOURCE_TABLES["invoices"].schema)
    found = {tuple(r) for r in quality.audit(SOURCE_TABLES, {"payments": payments, "invoices": invoices}).collect()}
    assert found == broken | {("payments", "invoice_id refers to no row", "7", 2)}
    assert quality.audit(SOURCE_TABLES, {"invoices": invoices}).count() == 0
