import random
import zlib

import pytest
from pyspark.sql import functions as F

from tallyfold.llm import quality
from tallyfold.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, score string, row int, label string"


def test_held_out(spark):
    rows = spark.range(-50, 500).select("id", quality.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


def corpus():
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefghij", k=rng.randrange(2, 8))) for _ in range(80)]
    docs, labels = [], []
    for i in range(400):
        good = i % 3 != 0
        text = " ".join(rng.choices(words, k=rng.randrange(20, 200)))
        docs.append((i, text if good else text.upper().replace(" ", "## "), "x", 1, "x"))
        labels.append((i, int(good), 0))
    return docs, labels


@pytest.fixture(scope="module")
def learned(spark):
    docs, labels = corpus()
    labels += [(1, 1, 0), (9000, 0, 1), (None, 1, 0), (2, None, 0)]
    docs += [(500, None, "x", 1, "x"), (501, "", "x", 1, "x"), (502, "é " * 100_000, "x", 1, "x"), (None, "hm", "x", 1, "x")]
    docs += [(501, "", "x", 1, "x")]
    frame = spark.createDataFrame(docs, SCHEMA)
    model = quality.train(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    return frame, model


def test_scores(learned):
    frame, model = learned
    rows = quality.score(frame, model).collect()
    assert len(rows) == frame.count()
    assert all(0 <= r.score <= 1 for r in rows)
    assert rows[0].row.score == "x"
    for r in rows:
        if r.row.doc_id is not None and r.row.doc_id < 400:
            assert (r.score >= 0.3) == (r.row.doc_id % 3 != 0)
    empty = {r.score for r in rows if r.row.doc_id in (500, 501)}
    assert len(empty) == 1


def test_same_again_and_whole_texts(learned):
    frame, model = learned
    sizes = model.sizes(["a b c " * 50_000, "a b c " * 50_000 + "".join(map(str, range(9999)))])
    assert sizes[1][0] > sizes[0][0] + 1000
    kept = quality.keep_good(frame, model, 0.3)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} >= {i for i in range(400) if i % 3}


def test_labels_of_held_out_rows_do_not_count(spark):
    docs, labels = corpus()
    frame = spark.createDataFrame(docs, SCHEMA)
    flipped = [(d, 1 - q if zlib.crc32(str(d).encode()) % 5 == 0 else q, t) for d, q, t in labels]
    one, two = (
        quality.train(frame, spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, flipped)
    )
    assert one.good == two.good and one.bad == two.bad and one.weights.tolist() == two.weights.tolist()


def test_no_labels_and_no_rows(spark):
    frame = spark.createDataFrame([(1, "a", "x", 1, "x")], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality.train(frame, labels)
    assert [r.score for r in quality.score(frame, model).collect()] == [0.5]
    assert quality.score(frame.limit(0), model).count() == 0


def test_held_out_accuracy(spark):
    """On sf0.1: nearly all good rows stay, most bad rows go."""
    folder = "/root/testdata/sf0.1"
    found = QUERIES["op7_quality"](spark, folder).where("held_out")
    rows = found.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    good = [r.predicted for r in rows if r.quality == 1]
    bad = [r.predicted for r in rows if r.quality == 0]
    print(len(good), sum(good) / len(good), len(bad), sum(bad) / len(bad))
    assert sum(good) / len(good) > 0.98
    assert sum(bad) / len(bad) < 0.25
