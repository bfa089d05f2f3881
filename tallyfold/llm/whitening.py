"""Whitening of integer-scaled embeddings.

The centred scatter matrix is factored by Cholesky with complete pivoting, which stops at the numerical rank. One-sided
Jacobi rotations then make the columns of the triangular factor orthogonal, directly, without another product: the
squared column norms are the eigenvalues of the scatter, the normalised columns its eigenvectors.

Vectors are read in three passes over partitions: exact sums, the scatter of the centred vectors, and the covariance of
the whitened vectors, which proves the result. A partition yields one matrix of dim x dim numbers, or fewer; the driver
receives the totals and does the factoring, so what it holds depends on the length of a vector alone. The rows
themselves are whitened where they lie, without any shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
# Directions with less than this share of the greatest variance are lost in the rounding of the scatter.
NEGLIGIBLE = 1e-10
LARGEST = 2.0**62  # scaled entries below it are longs

_HALF = 32  # bits of the lower part of a sum


def pivoted_cholesky(matrix: np.ndarray, negligible: float = NEGLIGIBLE) -> tuple[np.ndarray, np.ndarray]:
    """(factor, order): matrix[order][:, order] = factor @ factor.T, the factor lower trapezoidal of the matrix's rank."""
    rest = np.array(matrix, np.float64)
    order = np.arange(len(rest))
    factor = np.zeros_like(rest)
    rank, first = 0, None
    for k in range(len(rest)):
        at = k + int(np.argmax(np.diag(rest)[k:]))
        pivot = rest[at, at]
        first = pivot if first is None else first
        if not pivot > negligible * first:
            break
        for x in (rest, factor):
            x[[k, at]] = x[[at, k]]
        rest[:, [k, at]] = rest[:, [at, k]]
        order[[k, at]] = order[[at, k]]
        column = rest[k:, k] / np.sqrt(pivot)
        factor[k:, k] = column
        rest[k + 1 :, k + 1 :] -= np.outer(column[1:], column[1:])
        rank = k + 1
    return factor[:, :rank], order


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The columns of `factor`, rotated among each other until they are orthogonal.

    A round rotates disjoint pairs of columns at once; the rounds of a sweep pair every column with every other.
    """
    columns = np.array(factor.T, np.float64)
    count = len(columns)
    if count < 2:
        return columns.T
    ring = np.arange(count + count % 2)
    limit = np.finfo(np.float64).eps * np.sqrt(factor.shape[0])
    for _ in range(sweeps):
        turned = False
        for _ in range(len(ring) - 1):
            p, q = ring[: len(ring) // 2], ring[: len(ring) // 2 - 1 : -1]
            real = (p < count) & (q < count)
            p, q = p[real], q[real]
            a, b = columns[p], columns[q]
            aa, bb, ab = (np.einsum("ij,ij->i", x, y) for x, y in ((a, a), (b, b), (a, b)))
            turn = np.abs(ab) > limit * np.sqrt(aa * bb)
            if turn.any():
                turned = True
                p, q, a, b = p[turn], q[turn], a[turn], b[turn]
                slope = (bb[turn] - aa[turn]) / (2 * ab[turn])
                tangent = np.where(slope < 0, -1.0, 1.0) / (np.abs(slope) + np.hypot(1.0, slope))
                cosine = 1 / np.hypot(1.0, tangent)
                sine = cosine * tangent
                columns[p] = cosine[:, None] * a - sine[:, None] * b
                columns[q] = sine[:, None] * a + cosine[:, None] * b
            ring = np.concatenate([ring[:1], ring[-1:], ring[1:-1]])
        if not turned:
            break
    return columns.T


def eigen(scatter: np.ndarray, negligible: float = NEGLIGIBLE) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors in columns, of a positive semidefinite matrix. The largest entry of
    each vector is positive."""
    factor, order = pivoted_cholesky(scatter, negligible)
    rotated = one_sided_jacobi(factor)
    vectors = np.zeros_like(rotated)
    vectors[order] = rotated
    norms = np.linalg.norm(vectors, axis=0)
    falling = np.argsort(-norms, kind="stable")
    vectors, norms = vectors[:, falling] / norms[falling], norms[falling]
    top = np.abs(vectors).argmax(0) if vectors.size else np.zeros(0, int)
    return norms**2, vectors * np.sign(vectors[top, np.arange(vectors.shape[1])])


@dataclass
class Whitening:
    """What maps a vector to its whitened components; its size depends on the length of a vector alone."""

    dim: int
    rows: int
    sums: list[int]  # of the scaled entries, exact, without the offset
    directions: np.ndarray  # dim x components, divided by the square root of the eigenvalue
    explained: list[float]
    identity_error: float
    scale: int

    def centred(self, whole: np.ndarray) -> np.ndarray:
        """Entries less their mean; the integer part is subtracted before anything is rounded."""
        floor = np.array([s // self.rows for s in self.sums], np.int64)
        rest = np.array([s % self.rows / self.rows for s in self.sums])
        return (whole - floor).astype(np.float64) - rest

    def deviations(self, whole: np.ndarray) -> list[int]:
        """For each row the sum of (rows * entry - sum of entries) squared, exact at any size."""
        n = self.rows
        floor = np.array([s // n for s in self.sums], np.int64)
        rest = np.array([s % n for s in self.sums], np.int64)
        near = whole - floor
        size = int(np.abs(near).max(initial=0))
        if self.dim * size * max(size, n) >= 1 << 62:
            near, rest = near.astype(object), rest.astype(object)
        squares, products = (near * near).sum(1).tolist(), (near * rest).sum(1).tolist()
        constant = sum(int(r) ** 2 for r in rest)
        return [n * n * a - 2 * n * b + constant for a, b in zip(squares, products)]


def _integers(vectors: pa.Array, dim: int, scale: int) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(scale * flat).astype(np.int64).reshape(len(vectors), dim)


def _totals(vectors: DataFrame, dim: int, scale: int, work: Callable[[np.ndarray], np.ndarray]) -> list[list]:
    """The matrix that `work` makes of a batch of integer vectors, added up over all batches. Entries are float64, or
    int64 and then added exactly."""
    kind = "double" if work(np.zeros((0, dim), np.int64)).dtype == np.float64 else "long"

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            part = work(_integers(batch.column("vector"), dim, scale))
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total.tolist())], ["line", "value"])

    parts = vectors.select("vector").mapInArrow(partial, f"line int, value array<{kind}>")
    cells = parts.select("line", F.posexplode("value").alias("place", "value"))
    value = F.col("value") if kind == "double" else F.col("value").cast("decimal(38,0)")
    added = cells.groupBy("line", "place").agg(F.sum(value).alias("value")).groupBy("line")
    lines = added.agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("value")).orderBy("line").collect()
    return [[v.value for v in line.value] for line in lines]


def _usable(vector: Column, scale: int) -> Column:
    size = lambda x: F.abs(x.cast("double")) * scale
    return F.coalesce(F.forall(vector, lambda x: F.coalesce((size(x) < LARGEST) & ~F.isnan(x), F.lit(False))), F.lit(False))


def _vectors(rows: DataFrame, identity: str, vector: str, scale: int) -> DataFrame:
    named = rows.select(F.col(identity).alias("id"), F.col(vector).alias("vector"))
    return named.where(_usable(F.col("vector"), scale) & (F.size("vector") > 0))


def fit(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> Whitening | None:
    """The whitening of all usable rows; None if there are none, or all are equal.

    `rows` is read four times and has to be the same each time, as a stored table is. See `whiten` for the rows that count.
    """
    vectors = _vectors(rows, vector, vector, scale).select("vector")
    # As many lengths as vectors may occur: only the first comes to the driver.
    lengths = vectors.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    if not lengths:
        return None
    dim, n = lengths[0].dim, lengths[0]["count"]
    vectors = vectors.where(F.size("vector") == dim)
    mask = (1 << _HALF) - 1
    high, low = _totals(vectors, dim, scale, lambda x: np.stack([(x >> _HALF).sum(0), (x & mask).sum(0)]))
    sums = [(int(h) << _HALF) + int(c) for h, c in zip(high, low)]
    whitening = Whitening(dim, n, sums, np.zeros((dim, 0)), [], 0.0, scale)

    def scatter(x: np.ndarray) -> np.ndarray:
        centred = whitening.centred(x)
        return np.vstack([centred.T @ centred, centred.sum(0)])

    totals = np.array(_totals(vectors, dim, scale, scatter))
    total, left_over = totals[:-1], totals[-1] / n
    total = (total + total.T) / 2
    values, directions = eigen(total)
    if not len(values):
        return None
    values, directions = values[:components] / n, directions[:, :components]
    whitening.directions = directions / np.sqrt(values)
    whitening.explained = (values / (np.trace(total) / n)).tolist()

    # What rounding has left of the mean is taken off before the products here, too.
    shift = left_over @ whitening.directions

    def covariance(x: np.ndarray) -> np.ndarray:
        white = whitening.centred(x) @ whitening.directions - shift
        return white.T @ white

    found = np.array(_totals(vectors, dim, scale, covariance)) / n
    whitening.identity_error = float(np.abs(found - np.eye(len(found))).max())
    return whitening


def whiten(
    rows: DataFrame,
    identity: str = "vec_id",
    vector: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) for each usable row and component.

    An entry c counts as x = floor(scale * c) + OFFSET. `deviation` is the sum of (n * x - sum of x) squared over the
    entries, exact, null beyond 38 digits. `whitened` is the centred vector projected on the component, over the
    square root of the component's eigenvalue, `explained` the eigenvalue's share of the trace of the covariance,
    `identity_error` the largest entry of the whitened rows' measured covariance minus the identity.

    Rows are left out if the vector is null or empty, holds null or non-finite entries or such whose x is no long, or
    has not the length that most usable rows have (of equally frequent lengths, the greatest). Components number the
    eigenvalues from 1, falling; those below 1e-10 of the greatest have no rows, so equal vectors, a single row or
    none give no rows. Rows that share an id, a null id included, or are wholly equal, are rows of their own. Other
    columns are ignored. `rows` is read several times and has to be the same each time.
    """
    vectors = _vectors(rows, identity, vector, scale)
    kind = rows.schema[identity].dataType.simpleString()
    result = f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    model = fit(rows, vector, components, scale)
    if model is None:
        return rows.sparkSession.createDataFrame([], result)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = _integers(batch.column("vector"), model.dim, model.scale)
            white = model.centred(whole) @ model.directions
            cuts = np.arange(0, white.size + 1, white.shape[1], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(white.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), _decimals(model.deviations(whole)), lists], ["id", "deviation", "whitened"]
            )

    counted = vectors.where(F.size("vector") == model.dim)
    mapped = counted.mapInArrow(work, f"id {kind}, deviation decimal(38,0), whitened array<double>")
    each = mapped.select("id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return each.select(
        "id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.rows).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(F.lit(model.explained), F.col("place") + 1).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )


def _decimals(values: list[int]) -> pa.Array:
    kind = pa.decimal128(38, 0)
    if max(values, default=0) < 1 << 63:
        return pa.array(values, pa.int64()).cast(kind)
    return pa.array([Decimal(v) if v < 10**38 else None for v in values], kind)
