"""Each stage against a plain version on its own input, and the edge cases of tables."""

from collections import Counter

import numpy as np
import pytest
from test_simhash import expected, plain

import corpus_pipeline as pipeline
from tallyfold.llm import entities, quality
from tallyfold.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def stages(spark, small):
    """Rows of documents and of the result of each stage."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    results = [docs.collect()]
    for _, work in pipeline.STAGES:
        docs = pipeline.stage(work(spark, docs, small), "test")
        results.append(docs.collect())
    return results


def test_columns(spark, small, stages):
    for rows in stages[:-1]:
        assert list(rows[0].asDict()) == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality(spark, small, stages):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{small}/labels.parquet"))
    kept = {r.doc_id for r in stages[1]}
    for r in stages[0]:
        assert (r.doc_id in kept) == (model.scores([r.text])[0] >= pipeline.ACCEPT)
    assert 0.5 < len(kept) / len(stages[0]) < 1


def test_near_duplicates(stages):
    root = expected([plain(r.text) for r in stages[1]])
    first = {}
    for r in stages[1]:
        first[root[plain(r.text)]] = min(first.get(root[plain(r.text)], r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in stages[2]) == sorted(first.values())
    assert len(stages[2]) < len(stages[1])
    assert set(stages[2]) <= set(stages[1])


def test_pii(stages):
    after = {r.doc_id: r for r in stages[3]}
    assert len(after) == len(stages[2])
    for r in stages[2]:
        spans = entities.find(r.text)
        new = after[r.doc_id]
        assert (new.text == r.text) == (not spans)
        assert all(r.text[s.start : s.end] not in new.text for s in spans if s.end - s.start > 8)
        assert (new.lang, new.source, new.n_chars) == (r.lang, r.source, len(new.text))


def test_mix(stages):
    words = lambda rows: Counter({s: sum(len(r.text.split()) for r in rows if r.source == s) for s in {r.source for r in rows}})
    before, after = words(stages[3]), words(stages[4])
    names = sorted(before)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), sum(before.values())
    while True:
        rate = left / sum(weight[s] for s in free)
        over = {s for s in free if rate * weight[s] > 3 * before[s]}
        for s in over:
            target[s] = 3 * before[s]
            left -= target[s]
        free -= over
        if not over:
            break
    target.update({s: rate * weight[s] for s in free})
    assert all(abs(after[s] - target[s]) <= 64 for s in names)
    whole = {r.doc_id: r.text for r in stages[3]}
    copies = Counter(r.doc_id for r in stages[4])
    assert max(copies.values()) <= 3
    assert all(r.text.rstrip() in whole[r.doc_id] or " " in r.text for r in stages[4])
    assert all(r.n_chars == len(r.text) for r in stages[4])


def test_pack(stages):
    words = Counter(w for r in stages[4] for w in r.text.split())
    assert words == Counter(w for r in stages[5] for w in r.text.split())
    used = {}
    for r in stages[5]:
        used[r.bin] = used.get(r.bin, 0) + r.words
        assert len(r.text.encode().split()) == r.words and r.bin_used <= r.bin_length
    assert all(used[r.bin] == r.bin_used for r in stages[5])


def test_run_is_the_stages(spark, small, stages):
    assert sorted(map(str, QUERIES["pipeline"](spark, small).collect())) == sorted(map(str, stages[-1]))


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None)] * 2, [(1, "", "en", None, 0), (1, "", "en", None, 0)]])
def test_odd_tables(spark, small, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    for (_, work), want in zip(pipeline.STAGES, (None, min(len(rows), 1), min(len(rows), 1), 0, 0)):
        docs = pipeline.stage(work(spark, docs, small), "odd")
        if want is not None:
            assert docs.count() == want


def test_one_of_each_group(spark):
    """Equal ids, equal rows, null ids, other columns."""
    from tallyfold.llm import simhash

    rows = [(3, "a b c d e f g", "x"), (3, "h i j k l m n", "y"), (1, "A b c d e f g", "z"), (1, "A b c d e f g", "z"), (None, "h i j k l m n", "n"), (None, "zz yy xx ww", "q")]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, mark string")).collect()
    assert sorted((str(r.doc_id), r.mark) for r in kept) == [("1", "z"), ("3", "y"), ("None", "q")]
    assert np.all([r.text is not None for r in kept])
