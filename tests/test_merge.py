from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tallyfold.operators import merge
from tallyfold.plans.cycle import open_star

PRODUCT = "product_id long, product_name string, product_desc string, unit_price decimal(12,2), vat_rate decimal(5,2), updated_at timestamp_ntz"


def products(spark, rows):
    full = [(i, n, d, D(p) if p is not None else None, D("10"), None) for i, n, d, p in rows]
    return spark.createDataFrame(full, PRODUCT)


def stored(df):
    return {r["product_id"]: (r["product_key"], r["product_name"], r["product_desc"], r["unit_price"]) for r in df.collect()}


@pytest.mark.parametrize("limit", [merge.BROADCAST_BYTES, -1], ids=["broadcast", "shuffled"])
def test_upsert(spark, root, monkeypatch, limit):
    monkeypatch.setattr(merge, "BROADCAST_BYTES", limit)
    star = open_star(spark, root, block_rows=10)
    tx = star.begin()
    assert merge.upsert(tx, "dim_product", products(spark, [(7, "g", "dg", 7), (3, "c", "dc", 3), (25, "y", "dy", 25)])) == 3
    tx.commit()
    first = star.version()["tables"]["dim_product"]["parts"]
    assert stored(star.read("dim_product")) == {
        3: (1, "c", "dc", D("3.00")),
        7: (2, "g", "dg", D("7.00")),
        25: (3, "y", "dy", D("25.00")),
    }
    tx = star.begin()
    batch = [(3, "c2", "changed", None), (4, "d", "dd", 4), (31, "z", "dz", 31)]
    assert merge.upsert(tx, "dim_product", products(spark, batch)) == 3
    tx.commit()
    assert stored(star.read("dim_product")) == {
        3: (1, "c2", "dc", None),  # NULL overwrites, the description is frozen, the key stays
        7: (2, "g", "dg", D("7.00")),
        25: (3, "y", "dy", D("25.00")),
        4: (4, "d", "dd", D("4.00")),
        31: (5, "z", "dz", D("31.00")),
    }
    # The block of 25 was not touched, so its file is the same.
    second = star.version()["tables"]["dim_product"]["parts"]
    assert [p for p in first if p["block"] == 2] == [p for p in second if p["block"] == 2]


def test_upsert_of_nothing(spark, root):
    star = open_star(spark, root)
    tx = star.begin()
    assert merge.upsert(tx, "dim_product", products(spark, [])) == 0
    assert tx.read("dim_product").count() == 0


def test_repeated_key_in_batch_fails(spark, root):
    tx = open_star(spark, root).begin()
    with pytest.raises(merge.DuplicateKeyError):
        merge.upsert(tx, "dim_product", products(spark, [(1, "a", "a", 1), (1, "b", "b", 2)]))


def test_first_per_key_keeps_the_row_together(spark):
    df = spark.createDataFrame([("k", 2, "b", None), ("k", 1, None, "x"), ("l", 3, "c", "y")], "k string, o int, a string, b string")
    got = {r["k"]: (r["o"], r["a"], r["b"]) for r in merge.first_per_key(df, "k", F.col("o")).collect()}
    assert got == {"k": (1, None, "x"), "l": (3, "c", "y")}


def test_first_per_key_combines_before_the_shuffle(spark):
    df = merge.first_per_key(spark.range(100).selectExpr("id % 3 AS k", "id"), "k", F.col("id"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min_by") > plan.index("Exchange")  # plans print from the last step down


def test_insert_ignore_and_null_keys(spark):
    target = spark.createDataFrame([("a",), (None,)], "k string")
    batch = spark.createDataFrame([("a", 1), ("b", 3), ("b", 2), ("c", 4)], "k string, o int")
    got = sorted((r["k"], r["o"]) for r in merge.insert_ignore(target, batch, "k", F.col("o")).collect())
    assert got == [("b", 2), ("c", 4)]


def test_get_or_create_keeps_first_attributes(spark):
    existing = spark.createDataFrame([("old",)], "name string")
    candidates = spark.createDataFrame(
        [("x", 5, 50), ("old", 1, 10), ("y", 3, 30), ("x", 4, 40), (None, 2, 20)], "name string, line long, price int"
    )
    new, last = merge.get_or_create(existing, candidates, "name", "line", "id", 7)
    assert sorted((r["id"], r["name"], r["price"]) for r in new.collect()) == [(8, "y", 30), (9, "x", 40)]
    assert last == 9


def test_lookup_never_matches_null(spark):
    table = spark.createDataFrame([("a", 1), (None, 2)], "k string, id long")
    df = spark.createDataFrame([("a",), (None,), ("z",)], "k string")
    got = {r["k"]: r["id"] for r in merge.lookup_ids(df, table, "k", "id").collect()}
    assert got == {"a": 1, None: None, "z": None}


def test_first_rows_aggregate_without_sorting(spark):
    rows = [("k", 2, 0, "b"), ("k", 1, 5, None), ("k", 1, 3, "x"), ("l", 3, 0, "c"), ("m", 1 << 40, 2, "d"), ("m", 1 << 40, 1, "e")]
    df = spark.createDataFrame(rows, "k string, o long, p int, a string")
    got = {r["k"]: r["a"] for r in merge.first_rows(df, "k", "o", "p").collect()}
    assert got == {"k": "x", "l": "c", "m": "e"}
    plan = merge.first_rows(df, "k", "o", "p")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
