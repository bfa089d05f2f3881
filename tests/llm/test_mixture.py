import heapq
from fractions import Fraction

import oracle
import pytest
from pyspark.sql import functions as F

from tallyfold.llm import mixture
from tallyfold.llm.common import word_count
from tallyfold.llm.queries import QUERIES, SQL

SCHEMA = "doc_id long, source string, text string, size string, target int, row int"


def seats(shares, count, most):
    """Sainte-Laguë, one seat after the other."""
    won = [0] * len(shares)
    heap = [(-Fraction(s), i) for i, s in enumerate(shares) if s > 0 and most[i] > 0]
    heapq.heapify(heap)
    for _ in range(count):
        if not heap:
            break
        _, i = heapq.heappop(heap)
        won[i] += 1
        if won[i] < most[i]:
            heapq.heappush(heap, (-Fraction(shares[i]) / (2 * won[i] + 1), i))
    return won


@pytest.mark.parametrize("count", [0, 1, 7, 1000, 98765])
def test_apportion(spark, count):
    shares = [1, 1, 3, 1000, 77, 77, 0, 5000, 12, 1, 2, 999]
    most = [count] * 11 + [min(count, 40)]
    rows = [(0, i, float(s), count, m) for i, (s, m) in enumerate(zip(shares, most))]
    df = spark.createDataFrame(rows, "g int, i int, share double, seats long, most long")
    got = mixture.apportion(df, ["g"], "share", "seats", "most", ["i"], "won").orderBy("i").collect()
    if count <= 1000 and most[11] * 2 > count * 999 / 7173:
        assert [r.won for r in got] == seats(shares, count, most)
    assert all(r.won <= r.most for r in got)


def fill(sizes):
    """Targets by sharing the excess again until no source is above three times its size."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: Fraction((5, 2, 1)[i % 3]) for i, s in enumerate(names)}
    target, free, left = {}, set(names), Fraction(sum(sizes.values()))
    while free:
        rate = left / sum(weight[s] for s in free)
        over = {s for s in free if rate * weight[s] > 3 * sizes[s]}
        if not over:
            target.update({s: rate * weight[s] for s in free})
            break
        for s in over:
            target[s] = Fraction(3 * sizes[s])
            left -= target[s]
        free -= over
    return target


def test_targets_and_taken(spark):
    """Null and empty texts, a null source, a source without words, equal ids, a long text, clashing columns."""
    rows = []
    for i in range(900):
        source = ["a", "b", "é", "z", None, "hot", "hot", "hot"][i % 8]
        rows.append((i // 2, source, " ".join(["w"] * (i * 37 % 301)), "x", 1, 2))
    rows += [(5000, "void", None, "x", 1, 2), (5001, "void", " \t\n", "x", 1, 2), (None, "a", "one two", "x", 1, 2)]
    rows += [(6000, "tiny", "only few words here", "x", 1, 2), (6001, "z", "long " * 20_000, "x", 1, 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    mixed = mixture.mix(df, "doc_id", "source", word_count(F.col("text")), carry=True, shard_rows=50).collect()
    assert len(mixed) == len(rows)
    sizes, taken = {}, {}
    for r in mixed:
        words = len((r.row.text or "").encode().split())
        assert r.size == words and r.row.size == "x"
        assert 0 <= r.taken <= 3 * words
        sizes[r.row.source] = sizes.get(r.row.source, 0) + words
        taken[r.row.source] = taken.get(r.row.source, 0) + r.taken
    wanted = fill(sizes)
    for r in mixed:
        assert r.source_size == sizes[r.row.source]
        assert abs(r.target - float(wanted[r.row.source])) <= 1e-6 * (1 + r.target)
    for s, t in wanted.items():
        shards = -(-sum(r.row.source == s for r in mixed) // 50)
        assert abs(taken[s] - t) <= mixture.BLOCK_WORDS * (1 + 3 * shards)


def test_texts(spark):
    """The mixed rows hold the words that `taken` counts, whole rows unchanged."""
    rows = [(i, "ab"[i % 2], " ".join(f"w{i}-{j}" for j in range(i % 40)) + "\n", "x", 1, 2) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    mixed = mixture.mix(df, "doc_id", "source", word_count(F.col("text")), carry=True)
    texts = mixture.mixed_texts(mixed, "text")
    assert texts.columns == df.columns
    count = {}
    for r in texts.collect():
        words = r.text.split()
        assert all(w.startswith(f"w{r.doc_id}-") for w in words)
        count[r.doc_id] = count.get(r.doc_id, 0) + len(words)
    for r in mixed.collect():
        assert count.get(r.id, 0) == r.taken


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    mixed = mixture.mix(df, "doc_id", "source", word_count(F.col("text")), carry=True)
    assert mixed.count() == 0
    assert mixture.mixed_texts(mixed, "text").count() == 0


def test_query_against_sql(spark, small, sql):
    assert oracle.compare(QUERIES["op2_mix_sources"](spark, small), sql, SQL["op2_mix_sources"]) == []


def test_no_python(spark, small):
    plan = QUERIES["op2_mix_sources"](spark, small)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan
