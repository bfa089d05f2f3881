from pyspark.sql import functions as F

from tallyfold.operators import keys


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_gapped_ids_are_ranked(spark):
    ids = [3, 900_000, 70_000, 70_001, 5_000_000]
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    numbered, last = keys.assign_keys(df, "id", 10, "k")
    assert {r["id"]: r["k"] for r in numbered.collect()} == {3: 11, 70_000: 12, 70_001: 13, 900_000: 14, 5_000_000: 15}
    assert last == 15
    assert "SinglePartition" not in plan(numbered)


def test_dense_ids_need_no_shuffle(spark):
    df = spark.range(1000, 51_000).repartition(7)
    numbered, last = keys.assign_keys(df, "id", 5, "k")
    assert last == 50_005
    assert numbered.where(F.col("k") != F.col("id") - 1000 + 6).count() == 0
    assert "Window" not in plan(numbered)


def test_repeated_ids_are_not_taken_for_dense(spark):
    # Five rows between 1 and 5, but 2 is there twice and 4 is missing.
    df = spark.createDataFrame([(i,) for i in (1, 2, 2, 3, 5)], "id long")
    numbered, _ = keys.assign_keys(df, "id", 0, "k")
    assert sorted(r["k"] for r in numbered.collect()) == [1, 2, 3, 4, 5]


def test_second_order_column(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (9, 0)], "id long, pos int")
    numbered, last = keys.assign_keys(df, "id", 0, "k", ("pos",))
    assert {(r["id"], r["pos"]): r["k"] for r in numbered.collect()} == {(1, 0): 1, (1, 1): 2, (9, 0): 3}
    assert last == 3


def test_nothing_to_number(spark):
    numbered, last = keys.assign_keys(spark.range(0), "id", 42, "k")
    assert numbered.count() == 0 and last == 42 and numbered.columns == ["id", "k"]


def test_any_order_with_a_hot_leading_value(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("a"), "id")
    numbered, last = keys.assign_keys_by_range(df, ["a", "id"], 0, "k")
    expected = sorted(("hot" if i % 3 == 0 else str(i), i) for i in range(20_000))
    assert [(r["a"], r["id"]) for r in numbered.orderBy("k").collect()] == expected
    assert last == 20_000
    assert sorted(r["k"] for r in numbered.collect()) == list(range(1, 20_001))


def test_number_of_groups_is_bounded(spark):
    for high in (10, 10**6, 10**9, 10**13):
        width = keys.block_width(spark, 0, high)
        assert high // width <= keys.MOST_BLOCKS
        assert width >= keys.SMALL_BLOCK


def test_offsets_over_many_spans(spark, monkeypatch):
    """More groups than a span holds, with gaps; the driver sees one total for each span."""
    monkeypatch.setattr(keys, "SPAN", 8)
    counts = {g: g % 5 + 1 for g in range(0, 900, 3)}
    frame = spark.createDataFrame(list(counts.items()), f"{keys.GROUP} long, n long").repartition(5)
    offsets, last = keys.offsets_of(frame, 100)
    expected, at = {}, 100
    for group in sorted(counts):
        expected[group] = at
        at += counts[group]
    assert {r[keys.GROUP]: r[keys.OFFSET] for r in offsets.collect()} == expected and last == at


def test_running_totals(spark):
    rows = [(f"f{i % 7}", i, i % 4) for i in range(500)]
    df = spark.createDataFrame(rows, "file string, split long, n long").repartition(6)
    found, total = keys.running_totals(df, ["file", "split"], "n", "before")
    expected, at = {}, 0
    for file, split, n in sorted(rows):
        expected[file, split] = at
        at += n
    assert {(r.file, r.split): r.before for r in found.collect()} == expected and total == at
    assert keys.running_totals(df.where("false"), ["file", "split"], "n", "before")[1] == 0


def test_few_rows_reach_the_driver(spark, monkeypatch):
    """Numbering of ids in tens of thousands of groups."""
    monkeypatch.setattr(keys, "SMALL_BLOCK", 1)
    monkeypatch.setattr(keys, "LARGE_BLOCK", 1)
    collected = []
    real = type(spark.range(1)).collect
    monkeypatch.setattr(type(spark.range(1)), "collect", lambda df: collected.append(r := real(df)) or r)
    df = spark.range(20_000).selectExpr("id * 3 AS id")
    numbered, last = keys.assign_keys(df, "id", 0, "k")
    assert last == 20_000 and max(len(r) for r in collected) <= 60_000 // keys.SPAN + 1
    assert numbered.where("k <> id / 3 + 1").isEmpty()
