import datetime

import pytest

from tallyfold.operators.incremental import get_mark
from tallyfold.plans.cycle import init_marks, init_star, open_star, reset_star
from tallyfold.plans.ingest import open_source
from tallyfold.schemas import STREAMS
from tallyfold.sources.store import ConflictError


def clients(spark, ids, name="n"):
    rows = [(i, name, "a", f"t{i}", None, None, None) for i in ids]
    return spark.createDataFrame(
        rows,
        "client_id long, client_name string, client_address string, client_tax_id string, iban string, "
        "created_at timestamp_ntz, updated_at timestamp_ntz",
    )


def names(df):
    return {r["client_id"]: r["client_name"] for r in df.collect()}


def test_nothing_is_visible_before_commit(spark, root):
    store = open_source(spark, root, block_rows=10)
    tx = store.begin()
    tx.append("clients", clients(spark, [1, 2]))
    assert store.read("clients").count() == 0
    assert tx.read("clients").count() == 2
    tx.commit()
    assert store.read("clients").count() == 2


def test_versions_stay_readable(spark, root):
    store = open_source(spark, root, block_rows=10)
    for i in (1, 2):
        tx = store.begin()
        tx.append("clients", clients(spark, [i]))
        tx.commit()
    assert store.read("clients", version=1).count() == 1
    assert store.read("clients").count() == 2
    assert open_source(spark, root).latest() == 2


def test_rewrite_touches_only_named_blocks(spark, root):
    store = open_source(spark, root, block_rows=10)
    tx = store.begin()
    tx.append("clients", clients(spark, [1, 5, 15, 25]))
    tx.commit()
    before = {p["block"]: p["path"] for p in store.version()["tables"]["clients"]["parts"]}
    assert set(before) == {0, 1, 2}
    tx = store.begin()
    tx.rewrite_blocks("clients", clients(spark, [15], "new"), [1])
    tx.commit()
    after = {p["block"]: p["path"] for p in store.version()["tables"]["clients"]["parts"]}
    assert after[0] == before[0] and after[2] == before[2] and after[1] != before[1]
    assert names(store.read("clients")) == {1: "n", 5: "n", 15: "new", 25: "n"}
    assert store.begin().read("clients", blocks=[2]).count() == 1


def test_second_writer_loses(spark, root):
    store = open_source(spark, root)
    first, second = store.begin(), store.begin()
    first.append("clients", clients(spark, [1]))
    second.append("clients", clients(spark, [2]))
    first.commit()
    with pytest.raises(ConflictError):
        second.commit()
    assert names(store.read("clients")) == {1: "n"}


def test_since_skips_old_folders(spark, root):
    star = open_star(spark, root)
    schema = star.tables["fact_payment"].schema
    tx = star.begin()
    for key, month in ((1, 1), (2, 2)):
        stamp = datetime.datetime(2024, month, 1)
        tx.append("fact_payment", spark.createDataFrame([(key, 1, 1, None, "m", "r", stamp, key)], schema))
    assert tx.read("fact_payment", since="2024-01-15 00:00:00").count() == 1
    assert tx.read("fact_payment").count() == 2


def test_no_rows_leave_no_folder_behind(spark, root):
    star = open_star(spark, root)
    tx = star.begin()
    for table in ("fact_payment", "dim_client"):
        tx.append(table, spark.createDataFrame([], star.tables[table].schema))
    tx.commit()
    assert all(not t["parts"] for t in star.version()["tables"].values())


def test_init_and_reset(spark, root):
    star = open_star(spark, root)
    init_star(star)
    init_star(star)
    assert star.latest() == 1
    init_marks(star)
    init_marks(star)
    marks = star.read("etl_watermarks")
    assert sorted(r[0] for r in marks.collect()) == sorted(STREAMS)
    assert str(get_mark(marks, "clients")) == "1900-01-01 00:00:00"
    assert get_mark(marks, "unknown") is None
    reset_star(star)
    assert all(star.read(t).count() == 0 for t in star.tables)


def test_point_filter_and_columns_reach_the_scan(spark, root):
    store = open_source(spark, root, block_rows=10)
    tx = store.begin()
    tx.append("clients", clients(spark, range(30)))
    tx.commit()
    df = store.read("clients").where("client_tax_id = 't7'").select("client_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(client_tax_id,t7)" in plan
    assert "ReadSchema: struct<client_id:bigint,client_tax_id:string>" in plan
