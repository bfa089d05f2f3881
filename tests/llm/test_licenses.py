import random
import re

import oracle
import pytest

from tallyfold.llm import licenses
from tallyfold.llm.queries import QUERIES, SQL

SCHEMA = "doc_id long, text string, id string, words string, k int, size int, template int"


def shingles(text, k):
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    return [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)]


def plain(texts):
    """{(doc, license): best share} by trying every window against every template."""
    found = {}
    for name, template in licenses.TEMPLATES:
        k = min(5, len(shingles(template, 1)))
        wanted = set(shingles(template, k))
        size = licenses.size_class(len(wanted))
        step = -(-size // 2)
        for doc, text in texts:
            own = shingles(text, k)
            for start in range(0, len(own), step):
                share = len(wanted & set(own[start : start + size + step])) / len(wanted)
                if share >= 0.8:
                    found[doc, name] = max(found.get((doc, name), 0), share)
    return found


def corpus():
    rng = random.Random(6)
    words = [f"w{i}" for i in range(100)] + ["the", "license", "software", "under"]
    rows = []
    for i in range(150):
        noise = lambda: " ".join(rng.choices(words, k=rng.randrange(0, 120)))
        _, text = rng.choice(licenses.TEMPLATES)
        parts = text.split()
        if i % 3 == 1 and len(parts) > 12:  # some words changed
            for _ in range(rng.randrange(0, 3)):
                parts[rng.randrange(len(parts))] = "x"
        if i % 3 == 2:
            parts = parts[: max(3, int(len(parts) * rng.random() * 1.3))]
        rows.append((i, f"{noise()}\n{' '.join(parts)}{rng.choice(['', '***', '!!'])} {noise()}"))
    rows += [(900, None), (901, ""), (902, "é ü " * 50_000 + "All  RIGHTS-reserved"), (903, "Released under the"), (904, "...")]
    rows += [(905, "Released under the MIT License. " * 400)]
    return rows


def test_against_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, "x", "x", 1, 1, 1) for r in rows], SCHEMA)
    found = licenses.scan(df).collect()
    assert {(r.id, r.license): r.containment for r in found} == plain(rows)
    assert len(found) > 100
    text = dict(rows)
    for r in found:
        words = [w for w in re.split(r"[\W_]+", text[r.id].lower()) if w]
        assert 0 <= r.start_word < r.end_word <= len(words)
        assert words[r.start_word : r.end_word][0] in " ".join(t for _, t in licenses.TEMPLATES).lower()


def test_equal_and_null_ids(spark):
    rows = [(1, "All rights reserved."), (1, "Released under the MIT License."), (1, "All rights reserved."), (None, "All rights reserved")]
    df = spark.createDataFrame([(*r, "x", "x", 1, 1, 1) for r in rows], SCHEMA)
    found = sorted((str(r.id), r.license) for r in licenses.scan(df).collect())
    assert found == [("1", "MIT"), ("1", "Proprietary"), ("None", "Proprietary")]


def test_bands_keep_the_bound():
    """Whatever a window holds besides `CONTAINED` of a template, it misses with a chance of at most 1e-4."""
    for shingles in range(1, 300):
        size = licenses.size_class(shingles)
        window = size + -(-size // 2)
        held = next(h for h in range(1, shingles + 1) if h / shingles >= licenses.CONTAINED)
        assert (1 - held / (window + shingles - held)) ** licenses.bands_of(shingles, licenses.CONTAINED) <= 1.0001e-4


def test_short_notices_in_running_text(spark):
    """Notices of one shingle amid ever new words: of 20,000 none is missed."""
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(10**9)}"
    noise = lambda: " ".join(word() for _ in range(9))
    short = tuple((str(i), " ".join(word() for _ in range(5))) for i in range(200))
    rows = [(i, f"{noise()} {short[i % 200][1]} {noise()}") for i in range(20_000)]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), templates=short)
    assert {(r.id, r.license) for r in found.collect()} == {(i, str(i % 200)) for i, _ in rows}


@pytest.mark.parametrize("rows", [[], [(1, None, "x", "x", 1, 1, 1)], [(1, "no notice here at all", "x", "x", 1, 1, 1)]])
def test_nothing(spark, rows):
    assert licenses.scan(spark.createDataFrame(rows, SCHEMA)).count() == 0


def test_query_against_sql(spark, small, sql):
    df = QUERIES["op4_license_scan"](spark, small)
    assert oracle.compare(df, sql, SQL["op4_license_scan"]) == []
    assert df.count() > 0


def test_plan_is_native(spark, small):
    plan = QUERIES["op4_license_scan"](spark, small)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|ArrowEval|MapIn|Cartesian|NestedLoop", plan)
