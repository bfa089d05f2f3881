import numpy as np
import oracle
import pytest
from pyspark.sql import functions as F

from tallyfold.llm import negatives
from tallyfold.llm.queries import QUERIES, SQL

SCHEMA = "vec_id long, embedding array<double>, label string, place int, rank string, score string"


@pytest.mark.parametrize(
    "dim, size", [(64, 200), (64, 3), (1, 10**6), (300, 1000), (3000, 50), (5, 10**8), (2, 2 * 10**9), (0, 1)]
)
def test_products_are_exact(dim, size):
    rng = np.random.default_rng(dim)
    a, b = rng.integers(-size, size + 1, (40, dim)), rng.integers(-size, size + 1, (30, dim))
    a[0], b[0], b[1] = size, size, -size
    system = negatives.Residues(dim, dim * size * size + 1)
    assert all(p % 2 for p in system.primes) and len(set(system.primes)) == len(system.primes)
    found = system.product(system.split(a), system.split(b))
    assert (found.astype(np.int64) == a @ b.T).all()


def plain(rows, is_anchor, positives=5, negatives=10):
    """Pair by pair, in Python integers."""
    good = []
    for n, (name, vector, label) in enumerate(rows):
        if label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        whole = [int(np.floor(256 * x)) for x in vector]
        if sum(x * x for x in whole) < 8.9e18:
            good.append((n, name, whole, label))
    order = lambda r: (-r[1], r[0] is None, r[0] or 0)
    out = []
    for n, name, vector, label in good:
        if not is_anchor(name):
            continue
        scored = [(i, sum(x * y for x, y in zip(vector, v)), kind, m) for m, i, v, kind in good if len(v) == len(vector)]
        alike = sorted((r for r in scored if r[2] == label and r[3] != n), key=order)[:positives]
        for positive in alike:
            far = [r for r in scored if r[2] != label and 30 * positive[1] <= 100 * r[1] <= 90 * positive[1]]
            for rank, r in enumerate(sorted(far, key=order)[:negatives], 1):
                out.append((name, positive[0], rank, r[0], positive[1], r[1]))
    return sorted(out, key=str)


def mined(spark, rows, block=negatives.BLOCK):
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).repartition(3)
    found = negatives.mine(df, F.col("vec_id") % 4 == 0, block=block)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def is_anchor(name):
    return name is not None and name % 4 == 0


@pytest.mark.parametrize("block", [16, 1 << 15])
def test_against_brute_force(spark, monkeypatch, block):
    """Ties, one hot label, rare labels, shared and null ids, wholly equal rows, other lengths, odd vectors."""
    monkeypatch.setattr(negatives, "LEAST", 8)
    rng = np.random.default_rng(5)
    nan, inf = float("nan"), float("inf")
    rows = [(i, (rng.integers(-8, 9, 6) / 4).tolist(), "a" if i % 3 else str(i % 9)) for i in range(120)]
    rows += rows[:6] + [(7, rows[8][1], "b"), (8, rows[9][1], "a"), (None, rows[4][1], "a"), (None, rows[8][1], "z")]
    rows += [(200, None, "a"), (204, [nan] * 6, "a"), (208, [inf] + [0.0] * 5, "a"), (212, [None] + [1.0] * 5, "b")]
    rows += [(216, [0.0] * 6, "a"), (220, [1.0] * 6, None), (224, [1e30] + [1.0] * 5, "a"), (228, [], "a"), (229, [], "b")]
    rows += [(232 + i, [0.5, float(i)], "ab"[i % 2]) for i in range(9)] + [(400, [2.0e6] * 6, "only")]
    assert mined(spark, rows, block) == plain(rows, is_anchor)


def test_large_components(spark):
    rng = np.random.default_rng(6)
    rows = [(i, (rng.random(5) * 4e6).tolist(), "ab"[i % 2]) for i in range(40)]
    found = mined(spark, rows)
    assert found == plain(rows, is_anchor) and len(found) > 100


def test_empty_and_alone(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], "a")]) == []
    assert mined(spark, [(0, [1.0], "a"), (4, [2.0], "b")]) == []


def test_against_sql(spark, small, sql):
    assert oracle.compare(QUERIES["op11_hard_negatives"](spark, small), sql, SQL["op11_hard_negatives"]) == []
