"""Hard negatives by exact integer scores.

Vectors are scaled to integers and scored by inner products. The products run as matrix products in float32, yet are
exact: a residue number system stands for each integer by its remainders modulo a few small odd primes. The primes are
chosen so that no sum within a product leaves the integers that float32 holds, and so many that their product exceeds
four times the largest possible score. Chinese remaindering (Garner's mixed radix with signed digits) rebuilds the
signed score from the remainders.

Every anchor meets every row, in cells of one block of rows and one block of anchors. A row is dealt to its block by
its place in the staged table, so no id, label or repeated row makes a block larger than others. A cell is one
partition; it yields the few best rows of each of its anchors, and a window over the cells' yields selects the rest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.session import stage

SCALE = 256
BLOCK = 1 << 15  # rows, or anchors, of a cell
LEAST = 1 << 10  # rows that are worth a block of their own
STEP = 1 << 19  # scores held at once
WIDE = 1024  # columns that one float32 product adds up
EXACT = 1 << 24  # float32 holds all integers up to this
LONGEST = 9.0e18  # squared integer length; scores of shorter vectors fit a long


class Residues:
    """Exact products of integer matrices of `dim` columns whose results do not exceed `bound` in size."""

    def __init__(self, dim: int, bound: int):
        self.width = min(max(dim, 1), WIDE)
        # Neither a sum of products nor a digit times an inverse may leave the exact integers.
        half = min(math.isqrt(EXACT // self.width), math.isqrt(EXACT // 4))
        self.primes: list[int] = []
        product, candidate = 1, 2 * half + 1
        while product <= 4 * bound or not self.primes:
            if all(candidate % d for d in range(3, math.isqrt(candidate) + 1, 2)):
                self.primes.append(candidate)
                product *= candidate
            candidate -= 2
        # Partial results are computed in the narrowest type that holds them.
        self.type = np.float32 if product < EXACT else np.float64 if product < 1 << 53 else np.int64

    def split(self, x: np.ndarray) -> list[np.ndarray]:
        """The remainders of a matrix, one float32 matrix for each prime, in signed form."""
        x = x.astype(np.float64)
        return [(x - p * np.rint(x / p)).astype(np.float32) for p in self.primes]

    def product(self, left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
        """left @ right.T of the matrices that were split."""
        digits: list[np.ndarray] = []
        for i, (p, a, b) in enumerate(zip(self.primes, left, right)):
            digit = np.zeros((len(a), len(b)), np.float32)
            for s in range(0, a.shape[1], self.width):
                digit += _centred(a[:, s : s + self.width] @ b[:, s : s + self.width].T, p)
            if a.shape[1] > self.width:
                _centred(digit, p)
            for q, known in zip(self.primes, digits):
                digit -= known
                digit *= _signed_inverse(q, p)
                _centred(digit, p)
            digits.append(digit)
        total = digits[-1].astype(self.type)
        for p, digit in zip(self.primes[-2::-1], digits[-2::-1]):
            total *= self.type(p)
            total += digit.astype(self.type, copy=False)
        return total


def _centred(x: np.ndarray, p: int) -> np.ndarray:
    """Remainders modulo `p` next to zero, in place. At the very ends of the range either sign may come out."""
    part = x * np.float32(1 / p)
    np.rint(part, out=part)
    part *= np.float32(p)
    x -= part
    return x


def _signed_inverse(q: int, p: int) -> np.float32:
    inverse = pow(q, -1, p)
    return np.float32(inverse - p if inverse > p // 2 else inverse)


def first_places(values: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the `k` highest values, highest first, ties by index."""
    at = np.arange(len(values))
    if len(values) > k:
        least = np.partition(values, len(values) - k)[len(values) - k]
        at = np.flatnonzero(values >= least)
    return at[np.argsort(-values[at], kind="stable")][:k]


@dataclass
class _Side:
    """Rows or anchors of a cell, of one vector length, in tie order."""

    rows: pa.Table
    matrix: np.ndarray
    label: np.ndarray
    place: np.ndarray


def _integers(vectors: pa.ChunkedArray, dim: int, scale: int) -> np.ndarray:
    flat = vectors.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(scale * flat).reshape(len(vectors), dim)


def _cells(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[tuple[int, _Side, _Side]]:
    """(length, rows, anchors) of the cell in this partition, for each length that has both."""
    kept = [b for b in batches if b.num_rows]
    if not kept:
        return
    cell = pa.Table.from_batches(kept)
    label = np.unique(cell["label"].to_numpy(), return_inverse=True)[1]
    dims, anchor, place = (cell[c].to_numpy() for c in ("dim", "anchor", "place"))
    null, name = cell["id"].is_null().to_numpy(), cell["id"].fill_null(0).to_numpy()
    for dim in np.unique(dims):
        sides = []
        for side in (False, True):
            at = np.flatnonzero((dims == dim) & (anchor == side))
            at = at[np.lexsort((place[at], name[at], null[at]))]
            rows = cell.take(pa.array(at))
            sides.append(_Side(rows, _integers(rows["vector"], int(dim), scale), label[at], place[at]))
        if all(len(s.place) for s in sides):
            yield int(dim), *sides


def _best_positives(batches, bound: int, scale: int, k: int):
    for dim, rows, anchors in _cells(batches, scale):
        system = Residues(dim, bound)
        found: list[tuple[np.ndarray, ...]] = []
        for label in np.intersect1d(rows.label, anchors.label):
            r, a = np.flatnonzero(rows.label == label), np.flatnonzero(anchors.label == label)
            right = system.split(rows.matrix[r])
            for s in range(0, len(a), step := max(STEP // len(r), 1)):
                part = a[s : s + step]
                scores = system.product(system.split(anchors.matrix[part]), right)
                for i, values in zip(part, scores):
                    best = first_places(values, k + 1)
                    best = best[rows.place[r[best]] != anchors.place[i]][:k]
                    found.append((np.full(len(best), i), r[best], values[best].astype(np.int64)))
        if found:
            i, r, score = (np.concatenate(x) for x in zip(*found))
            columns = {
                "place": pa.array(anchors.place[i]),
                "positive_id": rows.rows["id"].take(pa.array(r)),
                "positive_score": pa.array(score),
            }
            yield from pa.table(columns).to_batches()


def _best_negatives(batches, bound: int, scale: int, k: int, low: int, high: int):
    for dim, rows, anchors in _cells(batches, scale):
        system = Residues(dim, bound)
        right = system.split(rows.matrix)
        wanted = anchors.rows["scores"].to_pylist()
        found: list[tuple] = []
        for s in range(0, len(wanted), step := max(STEP // len(rows.place), 1)):
            scores = system.product(system.split(anchors.matrix[s : s + step]), right)
            for i, values in enumerate(scores, s):
                # Exact bounds; they are smaller than the positive score, so they fit its type.
                bounds = [(-(-low * p // 100), high * p // 100) for p in wanted[i]]
                usable = [b for b in bounds if b[0] <= b[1]]
                if not usable:
                    continue
                inside = (values >= min(b[0] for b in usable)) & (values <= max(b[1] for b in usable))
                at = np.flatnonzero(inside & (rows.label != anchors.label[i]))
                below = values[at][values[at] <= min(b[1] for b in usable)]
                if len(below) > k:
                    # Rows behind the k-th one under the lowest limit are no one's first k.
                    at = at[values[at] >= np.partition(below, len(below) - k)[len(below) - k]]
                at = at[np.argsort(-values[at], kind="stable")]
                falling = -values[at]
                for j, (least, most) in enumerate(bounds):
                    begin = np.searchsorted(falling, -most, "left")
                    end = min(np.searchsorted(falling, -least, "right"), begin + k)
                    if begin < end:
                        picked = at[begin:end]
                        found.append((np.full(len(picked), i), np.full(len(picked), j), picked, values[picked].astype(np.int64)))
        if found:
            i, j, r, score = (np.concatenate(x) for x in zip(*found))
            columns = {
                "place": pa.array(anchors.place[i]),
                "number": pa.array(j.astype(np.int32)),
                "negative_id": rows.rows["id"].take(pa.array(r)),
                "negative_score": pa.array(score),
            }
            yield from pa.table(columns).to_batches()


def _meet(rows: DataFrame, anchors: DataFrame, row_blocks: int, anchor_blocks: int) -> DataFrame:
    """Every row and every anchor in all cells of its block; a cell is a partition."""
    block = lambda n: F.pmod(F.xxhash64("place"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("row_block", block(row_blocks)).withColumn("anchor_block", every(anchor_blocks))
    right = anchors.withColumn("anchor_block", block(anchor_blocks)).withColumn("row_block", every(row_blocks))
    both = left.withColumn("anchor", F.lit(False)).unionByName(right.withColumn("anchor", F.lit(True)))
    cell = F.col("row_block") * anchor_blocks + F.col("anchor_block")
    return both.repartitionById(row_blocks * anchor_blocks, cell).drop("row_block", "anchor_block")


def mine(
    rows: DataFrame,
    anchor: Column,
    identity: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = SCALE,
    block: int = BLOCK,
) -> DataFrame:
    """For every anchor and each of its positives the hardest negatives: (anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score).

    Components x count as floor(scale * x); a score is the exact inner product. Higher scores come first, ties by
    smaller id, null ids last. An anchor (a row for which `anchor` is true) has as positives its first other rows of
    the same label, and as negatives of a positive the first rows of other labels whose score is at least `low` and at
    most `high` percent of the positive's. Fewer are returned where there are no more; an anchor without positives,
    or a positive without negatives, has no rows, and no rows give none.

    Rows with a null label, a null vector, or a null or non-finite component take no part, nor do those too long for
    their own score to fit a long (9e18). Vectors meet those of the same length only; an empty vector scores 0. Rows
    that share an id, or are wholly equal, are rows of their own. Other columns are ignored.
    """
    named = rows.select(
        F.col(identity).cast("long").alias("id"),
        F.col(label).alias("label"),
        F.size(vector).alias("dim"),
        F.col(vector).alias("vector"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    )
    finite = F.forall("vector", lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
    usable = named.where(F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
    # The length of x is at most that of |x| + 1 / scale in each component.
    square = lambda x: (scale * F.abs(x.cast("double")) + 1) * (scale * F.abs(x.cast("double")) + 1)
    length = F.aggregate("vector", F.lit(0.0), lambda total, x: total + square(x))
    sized = usable.withColumn("length", length).where(F.col("length") <= LONGEST)
    # The place of a row is fixed once it is staged, so a repeated task deals its rows as before.
    staged = stage(sized.withColumn("place", F.monotonically_increasing_id()), "vectors")
    total, chosen, longest = staged.agg(
        F.count(F.lit(1)), F.count_if("anchor"), F.max("length")
    ).first()
    bound = math.ceil(longest or 0) + 1
    parts = int(staged.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row_blocks = max(math.ceil(total / block), min(parts, math.ceil(total / LEAST)), 1)
    anchor_blocks = max(math.ceil(chosen / block), 1)

    rows_side = staged.select("place", "id", "label", "dim", "vector")
    anchors = staged.where("anchor").select("place", "id", "label", "dim", "vector")
    met = _meet(rows_side, anchors, row_blocks, anchor_blocks).mapInArrow(
        lambda batches: _best_positives(batches, bound, scale, positives), "place long, positive_id long, positive_score long"
    )
    best = Window.partitionBy("place").orderBy(F.desc("positive_score"), F.asc_nulls_last("positive_id"))
    ranked = met.withColumn("number", F.row_number().over(best)).where(F.col("number") <= positives)
    of_anchor = ranked.groupBy("place").agg(
        F.sort_array(F.collect_list(F.struct("number", "positive_id", "positive_score"))).alias("positives")
    )
    paired = stage(anchors.join(of_anchor, "place"), "positives")

    scored = paired.select(*anchors.columns, F.col("positives.positive_score").alias("scores"))
    none = F.lit(None).cast("array<bigint>")
    met = _meet(rows_side.withColumn("scores", none), scored, row_blocks, anchor_blocks).mapInArrow(
        lambda batches: _best_negatives(batches, bound, scale, negatives, low, high),
        "place long, number int, negative_id long, negative_score long",
    )
    hardest = Window.partitionBy("place", "number").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id"))
    ranked = met.withColumn("rank", F.row_number().over(hardest)).where(F.col("rank") <= negatives)
    names = paired.select(F.col("id").alias("anchor_id"), "place", F.posexplode("positives").alias("number", "positive"))
    return ranked.join(names, ["place", "number"]).select(
        "anchor_id", "positive.positive_id", "rank", "negative_id", "positive.positive_score", "negative_score"
    )
