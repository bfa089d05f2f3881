"""Near-duplicate embeddings by spherical-cap filters.

A filter is a direction; a vector belongs to it if the cosine between them reaches a threshold, that is if it lies in
the spherical cap around the direction. Directions come from structured random product codes: a code turns the vector
by a random rotation and cuts it into two blocks; each block has a few random unit vectors, and every combination of
one per block is a direction. So a vector's filters are found by list decoding, from the few inner products within the
blocks, without looking at all directions. Several codes together behave nearly as well as independent directions.
Vectors are joined on filters, and each meeting pair is verified by its cosine in double precision.

The number of directions follows the number of vectors, so that a filter holds a few unrelated vectors at any size.
The threshold is set for the codes at hand: the highest at which `RECALL` of random pairs, at exactly the wanted
cosine, share a filter. Closer pairs share more.

Vectors with equal components are one class from the start; only classes meet. A filter with many vectors is cut into
chunks that meet two by two (`arrow.cells`). Pairs are counted where they meet and never written out; each pair is
counted in the least filter that both vectors share.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.arrow import by_batch, cells, meet, runs
from tallyfold.llm.components import components
from tallyfold.session import stage

COSINE = 0.9
RECALL = 0.995
CODES = 16
SEED = 42
PAIRS = 1000  # random pairs that set the threshold
CHUNK = 512
STEP = 1 << 20  # inner products held at once


class Codes:
    """The directions for vectors of one length, about one for each row."""

    def __init__(self, dim: int, rows: int, codes: int = CODES, seed: int = SEED):
        blocks = 2 if dim > 1 else 1
        self.edges = [round(dim * i / blocks) for i in range(blocks + 1)]
        self.size = max(math.ceil((rows / codes) ** (1 / blocks)), 2)
        self.codes = []
        for i in range(codes):
            rng = np.random.default_rng([seed, dim, i])
            turn, _ = np.linalg.qr(rng.standard_normal((dim, dim)))
            words = [rng.standard_normal((self.size, b - a)) for a, b in zip(self.edges, self.edges[1:])]
            self.codes.append((turn, [w / np.linalg.norm(w, axis=1, keepdims=True) for w in words]))

    def decode(self, unit: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) for each filter that reaches `threshold`; rows ascending, filters ascending in a row."""
        step = max(STEP // self.size, 1)
        found = [
            self._decode(unit[s : s + step], threshold, s, i) for s in range(0, len(unit), step) for i in range(len(self.codes))
        ]
        row, name = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
        order = np.lexsort((name, row))
        return row[order], name[order]

    def _decode(self, unit: np.ndarray, threshold: float, first: int, number: int) -> tuple[np.ndarray, np.ndarray]:
        turn, words = self.codes[number]
        need = threshold * math.sqrt(len(words))
        turned = unit @ turn
        parts = [turned[:, a:b] @ w.T for a, b, w in zip(self.edges, self.edges[1:], words)]
        row, name, total = np.arange(len(unit)), np.full(len(unit), number), np.zeros(len(unit))
        for i, part in enumerate(parts):
            # A choice lives on only if the best choices for the other blocks could still reach the need.
            rest = sum((p.max(1) for p in parts[i + 1 :]), np.zeros(len(unit)))
            step = max(STEP // self.size, 1)
            kept = []
            for s in range(0, len(row), step):
                r = row[s : s + step]
                sums = total[s : s + step, None] + part[r]
                at, choice = np.nonzero(sums + rest[r][:, None] >= need)
                kept.append((r[at], name[s + at] * self.size + choice, sums[at, choice]))
            if not kept:
                break
            row, name, total = (np.concatenate(x) for x in zip(*kept))
        return row + first, name


@lru_cache(maxsize=8)
def codes_for(dim: int, rows: int) -> Codes:
    return Codes(dim, rows)


@lru_cache(maxsize=64)
def threshold(dim: int, rows: int, cosine: float = COSINE, recall: float = RECALL) -> float:
    """The highest threshold, in steps of 1/1024, at which `recall` of random pairs at `cosine` share a filter."""
    codes = codes_for(dim, rows)
    rng = np.random.default_rng([SEED, dim])
    x = _unit(rng.standard_normal((PAIRS, dim)))
    z = rng.standard_normal((PAIRS, dim))
    z -= (z * x).sum(1, keepdims=True) * x
    norm = np.linalg.norm(z, axis=1, keepdims=True)
    y = cosine * x + math.sqrt(1 - cosine**2) * np.divide(z, norm, out=np.zeros_like(z), where=norm > 1e-9)
    filters = codes.size ** len(codes.edges) * len(codes.codes)

    def shared(at: float) -> float:
        a, b = codes.decode(x, at), codes.decode(y, at)
        both = np.intersect1d(a[0] * filters + a[1], b[0] * filters + b[1], assume_unique=True)
        return len(np.unique(both // filters)) / PAIRS

    # From above: low thresholds have many filters and are seldom needed.
    low, high = 0, 1024
    width = 64
    while high - width > 0 and shared((high - width) / 1024) < recall:
        high -= width
    low = max(high - width, 0)
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if shared(middle / 1024) >= recall else (low, middle)
    return low / 1024


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two, which is exact, so that no square overflows or vanishes."""
    _, power = np.frexp(np.abs(x).max(1, keepdims=True))
    return np.ldexp(x, -power)


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cosines(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    left, right = _scaled(left), _scaled(right)
    return left @ right.T / np.outer(np.linalg.norm(left, axis=1), np.linalg.norm(right, axis=1))


def _matrix(vectors: pa.Array) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1)


def _valid(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _filters(classes: DataFrame, vector: str, rows: int, cosine: float, recall: float) -> DataFrame:
    """(node, weight, dim, vector, filters): every class with all its filters, ascending."""

    def work(batch: pa.RecordBatch) -> dict:
        dims = batch.column(2).to_numpy()
        lists: list = [None] * batch.num_rows
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            unit = _unit(_matrix(batch.column(3).take(pa.array(at))))
            row, name = codes_for(int(dim), rows).decode(unit, threshold(int(dim), rows, cosine, recall))
            cuts = np.searchsorted(row, np.arange(len(at) + 1))
            for i, a, b in zip(at, cuts, cuts[1:]):
                lists[i] = name[a:b]
        return {**{c: batch.column(c) for c in ("node", "weight", "dim", "vector")}, "filters": lists}

    kind = classes.schema[vector].dataType.simpleString()
    rows_in = classes.select("node", "weight", F.size(vector).alias("dim"), F.col(vector).alias("vector"))
    return by_batch(rows_in, work, f"node long, weight long, dim int, vector {kind}, filters array<long>")


def _meetings(entries: DataFrame, cosine: float) -> DataFrame:
    """(node, anchor, links): for each class in each cell one that it is connected with there, the same for all
    connected ones, and the number of vectors that it links to in pairs counted there."""
    key = ["dim", "filter"]
    laid = cells(entries, key, "node", CHUNK)

    def work(batches):
        for rows, starts in runs(batches, [*key, "lo", "hi"]):
            node, weight, side = (rows[c].to_numpy() for c in ("node", "weight", "side"))
            lo, hi, name = (rows[c].to_numpy() for c in ("lo", "hi", "filter"))
            vectors, lists = rows["vector"].combine_chunks(), rows["filters"].combine_chunks()
            out: list = []
            for s, e in zip(starts, starts[1:]):
                same = lo[s] == hi[s]
                cut = e if same else s + int(np.searchsorted(side[s:e], 1))
                left, right = np.arange(s, cut), np.arange(s if same else cut, e)
                if not len(left) or not len(right) or e - s < 2:
                    continue
                matrix = _matrix(vectors.slice(s, e - s))
                near = cosines(matrix[left - s], matrix[right - s]) >= cosine
                if same:
                    near |= near.T
                    np.fill_diagonal(near, False)
                if not near.any():
                    continue
                a, b = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
                near, left, right = near[np.ix_(a, b)], left[a], right[b]
                new = near & ~_met_before(lists, left, right, name[s])
                # With itself on the diagonal a member is one node, not a row and a column.
                rows_root, columns_root = meet(near | np.eye(len(left), dtype=bool) if same else near)
                out.append((node[left], node[left][rows_root], new @ weight[right]))
                if not same:
                    out.append((node[right], node[left][columns_root], new.T @ weight[left]))
            if out:
                columns = [pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*out)]
                yield pa.RecordBatch.from_arrays(columns, ["node", "anchor", "links"])

    chosen = laid.select(*key, "lo", "hi", "side", "node", "weight", "vector", "filters")
    return chosen.mapInArrow(work, "node long, anchor long, links long")


def _met_before(lists: pa.ListArray, left: np.ndarray, right: np.ndarray, name: int) -> np.ndarray:
    """Whether a pair shares a filter below `name`."""

    def earlier(members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        values = lists.take(pa.array(members))
        flat, cuts = values.flatten().to_numpy(), np.diff(values.offsets.to_numpy())
        member = np.repeat(np.arange(len(members)), cuts)
        return member[flat < name], flat[flat < name]

    (a, x), (b, y) = earlier(left), earlier(right)
    both = np.intersect1d(x, y)
    found = []
    for member, value, count in ((a, x, len(left)), (b, y, len(right))):
        has = np.zeros((count, len(both)), np.float32)
        at = np.searchsorted(both, value)
        hit = at < len(both)
        hit[hit] = both[at[hit]] == value[hit]
        has[member[hit], at[hit]] = 1
        found.append(has)
    return found[0] @ found[1].T > 0


def near_duplicates(
    rows: DataFrame,
    identity: str = "vec_id",
    vector: str = "embedding",
    cosine: float = COSINE,
    recall: float = RECALL,
) -> DataFrame:
    """One row per row of `rows`: id, links (other rows linked directly) and component, the least id reachable over
    links, itself included.

    Linked are rows whose cosine is at least `cosine`, computed in double precision; no pair below it is linked, and
    of pairs at the very threshold about `recall` are found. Vectors that are null, empty or zero, or hold null or
    non-finite components, link with nothing, nor do vectors of different lengths. Rows with equal vectors link. Rows
    that share an id are one node with the links of all its vectors; a null id takes part but names no component.
    Other columns are ignored. No rows give no rows.
    """
    vectors = rows.select(F.col(identity).cast("long").alias("id"), F.col(vector).alias("vector"))
    grouped = vectors.where(_valid(F.col("vector"))).groupBy("vector")
    classes = grouped.agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("weight"))
    # A class is named by its least id; where all ids are null, by a hash.
    named = F.coalesce("first", F.xxhash64("vector"))
    classes = stage(classes.withColumn("node", named), "classes")
    filtered = _filters(classes, "vector", classes.count(), cosine, recall)
    entries = filtered.withColumn("filter", F.explode("filters"))
    met = stage(_meetings(entries, cosine), "meetings")
    links = met.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(met.select(F.col("node").alias("a"), F.col("anchor").alias("b")))
    known = (
        classes.join(links, "node", "left")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
        .withColumn("links", F.col("weight") - 1 + F.coalesce("links", F.lit(0)))
    )
    least = known.groupBy("root").agg(F.min("first").alias("component"))
    known = stage(known.join(least, "root").select("vector", "links", "component"), "linked")
    # Rows that link with nothing have no class, and may not meet one by chance: NaN equals NaN in a join.
    usable = vectors.withColumn("key", F.when(_valid(F.col("vector")), F.col("vector")))
    return usable.join(known.withColumnRenamed("vector", "key"), "key", "left").select(
        "id",
        F.coalesce("links", F.lit(0).cast("long")).alias("links"),
        F.when(F.col("links").isNull(), F.col("id")).otherwise(F.col("component")).alias("component"),
    )
