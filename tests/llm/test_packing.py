import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfold.llm import packing
from tallyfold.llm.common import word_count
from tallyfold.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, size string, bin string, piece int"
CASES = [[], [0], [0, 0, 0], [512], [8192, 1], [8192] * 3, [1] * 2000, list(range(1, 1500)), [300] * 999, [4097, 4096, 4095]]


def plain(pieces, lengths, overhead):
    """The rule word for word: no index, every bin and every stock searched from end to end."""
    bins, content, where = [], [], []
    for i, piece in enumerate(pieces):
        fits = [(room, b) for b, room in enumerate(bins) if room >= piece]
        if fits:
            b = min(fits)[1]
        else:
            best = None
            for length in sorted(lengths):
                if length < piece:
                    continue
                room = length - piece
                for other in pieces[i + 1 :]:
                    if other <= room:
                        room -= other
                full = length - room
                price = (min(x for x in lengths if x >= full) + overhead) / max(full, 1)
                if best is None or price < best[0]:
                    best = (price, length)
            b = len(bins)
            bins.append(best[1])
            content.append(0)
        bins[b] -= piece
        content[b] += piece
        where.append(b)
    return where, [min(x for x in lengths if x >= c) for c in content]


@pytest.mark.parametrize("case", range(len(CASES) + 6))
def test_pack(case):
    rng = random.Random(case)
    pieces = CASES[case] if case < len(CASES) else [int(rng.paretovariate(0.7) * 20) % 8193 for _ in range(400)]
    pieces = sorted(pieces, reverse=True)
    bins, final = packing.pack(np.array(pieces, np.int64))
    where, lengths = plain(pieces, packing.LENGTHS, packing.OVERHEAD)
    assert bins.tolist() == where and final.tolist() == lengths


def test_rows(spark):
    """Null and empty texts, equal ids and rows, a null id, a long text; every word once and in order."""
    rng = random.Random(4)
    rows = [(i, " ".join(f"{i}_{j}" for j in range(rng.randrange(700))), "x", "x", 1) for i in range(300)]
    rows += [(1, None, "x", "x", 1), (2, "", "x", "x", 1), (2, "", "x", "x", 1), (None, "a b", "x", "x", 1)]
    rows += [(900, "\t" + "\n ".join(f"l{j}" for j in range(20_001)), "x", "x", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    packed = packing.best_fit(df, "doc_id", word_count(F.col("text")), "text", shard_rows=100).collect()
    held, texts = {}, {}
    for r in packed:
        held.setdefault(r.bin, []).append(r)
        texts.setdefault(r.id, []).append(r)
        assert len((r.text or "").split()) == r.words
    for parts in held.values():
        parts.sort(key=lambda r: (r.position, r.words))
        at = 0
        for r in parts:
            assert r.position == at and r.bin_length == parts[0].bin_length
            at += r.words
        assert at == parts[0].bin_used <= parts[0].bin_length
        assert parts[0].bin_length == min(x for x in packing.LENGTHS if x >= at)
    for i, text, *_ in rows:
        if i not in (1, 2):
            parts = sorted(texts[i], key=lambda r: r.start)
            assert " ".join(r.text for r in parts).split() == text.split()
    assert sum(r.id in (1, 2) for r in packed) == 5
    slim = packing.best_fit(df, "doc_id", word_count(F.col("text")), shard_rows=100).collect()
    key = lambda r: (r.bin, r.position, r.words, r.id or -1, r.piece)
    assert sorted(map(key, slim)) == sorted(map(key, packed))


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert packing.best_fit(df, "doc_id", word_count(F.col("text")), "text").count() == 0


def test_query(spark, small):
    rows = QUERIES["op10_pack"](spark, small).collect()
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    assert sum(r.words for r in rows) == sum(len(d.text.encode().split()) for d in docs)
    bins = {r.bin: (r.bin_used, r.bin_length) for r in rows}
    assert sum(u for u, _ in bins.values()) / sum(n for _, n in bins.values()) > 0.95
