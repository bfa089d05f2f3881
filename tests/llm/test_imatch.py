import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from tallyfold.llm import imatch
from tallyfold.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, id string, turn int, bucket string"


def corpus():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(3000)]
    texts = [" ".join(rng.choices(words, k=rng.randrange(0, 300))) for _ in range(250)]
    rows = [(i * 7 - 300, t, "x", 1, "x") for i, t in enumerate(texts)]
    rows += [(5000, None, "x", 1, "x"), (5001, "", "x", 1, "x"), (5002, "éà " * 40_000, "x", 1, "x"), (5003, "!!", "x", 1, "x")]
    rows += [(6000, texts[9], "x", 1, "x"), (6001, texts[9], "x", 1, "x"), (None, "no id", "x", 1, "x")]
    rows += [(7000, "same id b", "x", 1, "x"), (7000, "same id a", "x", 1, "x"), (7000, "same id a", "x", 1, "x")]
    rng.shuffle(rows)
    return rows


def band(rows):
    counts = Counter(w for r in rows for w in set(re.findall(r"\w+", (r[1] or "").lower())))
    n = len(rows)
    kept = [w for w, c in counts.items() if imatch.RARE * n <= c <= max(imatch.COMMON * n, 1)]
    return np.array(sorted(xxhash.xxh3_64_intdigest(w.encode()) for w in kept), np.uint64)


def plain(spark, rows):
    """All results, with the texts in one list."""
    words = band(rows)
    marked = spark.createDataFrame(rows, SCHEMA).selectExpr("doc_id", "text", "xxhash64(text) AS h").collect()
    marked.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h))
    texts = [r.text or "" for r in marked]
    prints = [imatch.fingerprint(imatch.terms(t), words) for t in texts]
    out = []
    for i, r in enumerate(marked):
        j = (i + 1) % len(marked)
        k = len(texts[i]) // 4
        new = texts[i][: len(texts[i]) - k] + texts[j][:k]
        mine = imatch.fingerprint(imatch.terms(new), words)
        near = imatch.likeness(prints[i], mine), imatch.likeness(prints[i], prints[j])
        out.append((r.doc_id, len(texts[i]), hashlib.sha256(new.encode()).hexdigest(), prints[i], mine, *near))
    return out


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r[0] or 0, r[2:]))


@pytest.mark.parametrize("bucket", [7, 100_000])
def test_against_plain(spark, monkeypatch, bucket):
    monkeypatch.setattr(imatch, "BUCKET", bucket)
    rows = corpus()
    found = imatch.edit_likeness(spark.createDataFrame(rows, SCHEMA)).collect()
    assert order(found) == order(plain(spark, rows))


def test_lexicon_is_the_band(spark):
    rows = corpus()
    assert imatch.lexicon(spark.createDataFrame(rows, SCHEMA), "text").tolist() == band(rows).tolist()


@pytest.mark.parametrize("rows", [[(1, "a lonely text")], [(None, None)], [(1, "x y"), (2, "y z")], [(3, "")] * 3])
def test_small_tables(spark, rows):
    rows = [(*r, "x", 1, "x") for r in rows]
    found = imatch.edit_likeness(spark.createDataFrame(rows, SCHEMA)).collect()
    assert order(found) == order(plain(spark, rows))


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert imatch.edit_likeness(df).count() == 0
    assert imatch.fingerprints(df).count() == 0


def test_fingerprints_of_rows(spark):
    rows = corpus()
    found = imatch.fingerprints(spark.createDataFrame(rows, SCHEMA)).collect()
    words = band(rows)
    assert len(found) == len(rows)
    assert all(r.fingerprint == imatch.fingerprint(imatch.terms(r.row.text), words) for r in found)


def test_likeness():
    words = np.arange(1, 2000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    words.sort()
    a = words[::4]
    half = np.sort(np.concatenate([a[:250], words[1::4][:250]]))
    same, close, far = (imatch.likeness(imatch.fingerprint(a, words), imatch.fingerprint(b, words)) for b in (a, half, words[2::4]))
    assert same == 1 and 0.1 < close < 0.8 and far < 0.1
    assert imatch.likeness(*[imatch.fingerprint(a[:0], words)] * 2) == 1


def test_query(spark, small):
    rows = QUERIES["op8_imatch"](spark, small).collect()
    assert len(rows) == spark.read.parquet(f"{small}/documents.parquet").count()
    assert np.mean([r.near_edited for r in rows]) > 0.4 and np.mean([r.near_next for r in rows]) < 0.1
    assert np.mean([r.near_edited > r.near_next for r in rows]) > 0.95
