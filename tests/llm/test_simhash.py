import random
import re

import brute
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyfold.llm import simhash
from tallyfold.llm.arrow import cells, meet
from tallyfold.llm.components import components
from tallyfold.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, fp string, id int, component string"


def plain(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lower)
    if not words:
        return 0
    parts = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


TEXTS = [None, "", " \t\n", "One", "one two", "ONE two\x0bthree", "a b c d É x", "ÀB cd ef gh", "x " * 30_000, "q w e r t y u i o p"]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain(text)


def test_hash_is_sparks(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("one two three")).alias("h")).first()
    assert row.h % (1 << 64) == xxhash.xxh64_intdigest(b"one two three", 42)


def expected(values):
    distinct = sorted(set(values))
    fps = np.array(distinct, np.uint64)
    near = [(int(a), int(b)) for a in fps for b in fps[np.bitwise_count(fps ^ a) <= 3] if a < b]
    return brute.roots(distinct, near)


def test_links_against_brute_force(spark, monkeypatch):
    """Chains, balls around one value, hot blocks cut into chunks, single bits, the sign bit."""
    rng = random.Random(5)
    values = [rng.getrandbits(64) for _ in range(300)]
    for _ in range(40):
        value = rng.getrandbits(64)
        for _ in range(rng.randrange(2, 30)):
            for _ in range(rng.randrange(0, 5)):
                value ^= 1 << rng.randrange(64)
            values.append(value)
    centre = rng.getrandbits(64)
    values += [centre ^ (1 << i) ^ (1 << j) for i in range(64) for j in range(i)]
    values += [0, 7, 15, 1 << 63, (1 << 63) | 3]
    wanted = expected(values)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in set(values)]
    df = spark.createDataFrame(signed, "fp long")
    monkeypatch.setattr(simhash, "cells", lambda *a: cells(*a, chunk=50))
    found = {r.node % (1 << 64): r.root % (1 << 64) for r in components(simhash.links(df)).collect()}
    groups = {}
    for v, root in found.items():
        groups.setdefault(root, set()).add(v)
    want = {}
    for v, root in wanted.items():
        want.setdefault(root, set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)


def test_meet():
    linked = np.zeros((4, 3), bool)
    linked[[0, 1, 1, 3], [2, 2, 0, 1]] = True
    left, right = meet(linked)
    assert left.tolist() == [0, 0, 2, 3] and right.tolist() == [0, 3, 0]


def test_components(spark):
    rng = random.Random(3)
    pairs = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1400)] + [(5, 5), (2000, 1999)]
    pairs += [(rng.randrange(3000, 3400), rng.randrange(3000, 3400)) for _ in range(250)]
    rng.shuffle(pairs)
    found = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    wanted = brute.roots({n for p in pairs for n in p}, pairs)
    assert found == {n: r for n, r in wanted.items() if n in found}
    assert set(found) == {n for a, b in pairs if a != b for n in (a, b)}


def test_documents(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, t, "x", 1, "x") for i, t in enumerate(TEXTS)] + [(None, "", "x", 1, "x"), (3, "One", "x", 1, "x")]
    for i in range(150):
        base = [rng.choice(words) for _ in range(rng.randrange(1, 400))]
        rows.append((100 + 3 * i, " ".join(base), "x", 1, "x"))
        rows.append((101 + 3 * i, " ".join(base + ["tail"]), "x", 1, "x"))
        rows.append((102 + 3 * i, " ".join(base).upper(), "x", 1, "x"))
    found = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == len(rows)
    root = expected([plain(r[1]) for r in rows])
    first = {}
    for doc, text, *_ in rows:
        if doc is not None:
            first[root[plain(text)]] = min(first.get(root[plain(text)], doc), doc)
    given = sorted(((r.id is None, r.id or 0), r.fp % (1 << 64), r.component) for r in found)
    assert given == sorted(((d is None, d or 0), plain(t), first[root[plain(t)]]) for d, t, *_ in rows)


def test_empty(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    root = expected([plain(r.text) for r in rows])
    first = {}
    for r in rows:
        first[root[plain(r.text)]] = min(first.get(root[plain(r.text)], r.doc_id), r.doc_id)
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op5_simhash"](spark, small).collect()}
    assert found == {r.doc_id: (f"{plain(r.text):016x}", first[root[plain(r.text)]]) for r in rows}
    assert len({c for _, c in found.values()}) < len(rows)
