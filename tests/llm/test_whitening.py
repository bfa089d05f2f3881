import numpy as np
import pytest

from tallyfold.llm import whitening
from tallyfold.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, id string, component string, vector string"
NAN, INF = float("nan"), float("inf")


def plain(vectors, scale=64):
    """(whole numbers, deviations, eigenvalues, eigenvectors, trace) in Python integers and a general eigensolver."""
    whole = [[int(np.floor(scale * c)) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(whole), [sum(c) for c in zip(*whole)]
    deviations = [sum((n * x - s) ** 2 for x, s in zip(v, sums)) for v in whole]
    centred = np.array([[(n * x - s) / n for x, s in zip(v, sums)] for v in whole])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return centred, deviations, values[::-1], vectors[:, ::-1]


def check(found, vectors, ids, components=32):
    centred, deviations, values, directions = plain(vectors)
    kept = min(int((values > 1e-10 * values[0]).sum()), components)
    assert len(found) == len(vectors) * kept
    assert {r.n for r in found} == {len(vectors)} and len({r.identity_error for r in found}) == 1
    assert found[0].identity_error < 1e-6
    white = {(r.vec_id, r.component): r for r in found}
    assert len(white) == len(found)
    for j in range(kept):
        column = np.array([white[i, j + 1].whitened for i in ids])
        wanted = centred @ directions[:, j] / np.sqrt(values[j])
        wanted *= np.sign(wanted @ column)
        assert np.abs(column - wanted).max() < 1e-6
        assert abs(white[ids[0], j + 1].explained / (values[j] / values.sum()) - 1) < 1e-8
    assert [int(white[i, 1].deviation) for i in ids] == deviations


@pytest.mark.parametrize("rank", [1, 2, 7, 40])
def test_factor_and_rotations(rank):
    rng = np.random.default_rng(rank)
    half = rng.standard_normal((40, rank)) * np.logspace(0, -4, rank)
    matrix = half @ half.T
    factor, order = whitening.pivoted_cholesky(matrix)
    assert factor.shape == (40, rank) and np.allclose(np.triu(factor, 1), 0)
    assert np.allclose(factor @ factor.T, matrix[np.ix_(order, order)], atol=1e-12 * matrix.max())
    rotated = whitening.one_sided_jacobi(factor)
    products = rotated.T @ rotated
    norms = np.sqrt(np.diag(products))
    assert np.abs(products / np.outer(norms, norms) - np.eye(rank)).max() < 1e-13
    values, vectors = whitening.eigen(matrix)
    assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:rank], rtol=1e-6)
    assert np.allclose(vectors.T @ vectors, np.eye(rank), atol=1e-12)
    assert np.allclose(matrix @ vectors, vectors * values, atol=1e-12 * values[0])


def test_nothing_to_factor():
    assert whitening.pivoted_cholesky(np.zeros((3, 3)))[0].shape == (3, 0)
    values, vectors = whitening.eigen(np.zeros((3, 3)))
    assert len(values) == 0 and vectors.shape == (3, 0)
    values, vectors = whitening.eigen(np.array([[4.0]]))
    assert values.tolist() == [4.0] and vectors.tolist() == [[1.0]]


def test_equal_eigenvalues():
    values, vectors = whitening.eigen(np.eye(9) * 3)
    assert np.allclose(values, 3) and np.allclose(vectors.T @ vectors, np.eye(9))


def test_against_plain_version(spark):
    """Odd vectors, other lengths, repeated rows, clashing columns, a constant and a copied dimension."""
    rng = np.random.default_rng(3)
    mixed = rng.standard_normal((200, 5)) @ rng.standard_normal((5, 5))
    vectors = np.hstack([mixed, np.full((200, 1), 0.3), mixed[:, :1]])
    vectors = np.concatenate([vectors, vectors[:20]])
    rows = [(i, v.tolist(), "x", "x", "x") for i, v in enumerate(vectors)]
    odd = [None, [], [NAN] * 7, [INF] + [1.0] * 6, [None] + [1.0] * 6, [1e300] + [1.0] * 6, [1.0] * 6, [1.0] * 8]
    rows += [(1000 + i, v, "x", "x", "x") for i, v in enumerate(odd)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = whitening.whiten(df).withColumnRenamed("id", "vec_id").collect()
    check(found, vectors, list(range(len(vectors))))
    assert {r.component for r in found} == {1, 2, 3, 4, 5}


def test_shared_and_null_ids(spark):
    rows = [(1, [1.0, 2.0], "", "", ""), (1, [1.0, 2.0], "", "", ""), (None, [3.0, 1.0], "", "", ""), (None, [0.0, 0.0], "", "", "")]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((str(r.id), r.component) for r in found) == sorted([("1", 1), ("1", 2), ("None", 1), ("None", 2)] * 2)
    assert found[0].identity_error < 1e-9


def test_large_entries_are_exact(spark):
    vectors = np.random.default_rng(4).random((50, 3)) * 1e13
    rows = [(i, v.tolist(), "", "", "") for i, v in enumerate(vectors)]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).withColumnRenamed("id", "vec_id").collect()
    check(found, vectors, list(range(50)))


def test_too_many_digits(spark):
    rows = [(i, [float(i) * 6e13], "", "", "") for i in range(1000)]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == 1000 and any(r.deviation is None for r in found)


@pytest.mark.parametrize("rows", [[], [(1, None, "", "", "")], [(1, [1.0, 2.0], "", "", "")], [(i, [0.5], "", "", "") for i in range(5)]])
def test_nothing_to_whiten(spark, rows):
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
    assert found.columns == ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert found.count() == 0


def test_query(spark, small):
    rows = spark.read.parquet(f"{small}/embeddings.parquet").collect()
    found = QUERIES["op12_whitening"](spark, small)
    kinds = dict(found.dtypes)
    assert kinds == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
        "explained": "double", "identity_error": "double",
    }
    check(found.collect(), [r.embedding for r in rows], [r.vec_id for r in rows])
