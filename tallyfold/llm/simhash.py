"""SimHash near-duplicates: fingerprints of word shingles, pigeonhole blocks, Hamming distance.

The 64 bits are cut into `max_bits + 3` blocks. Fingerprints that differ in at most `max_bits` bits agree in at least
three of them, so each fingerprint is entered under every choice of three blocks and meets all its neighbours; the
distance is then checked. Three blocks together (32 bits for 3 differing bits) keep chance meetings rare, as the
number of chance pairs grows with the square of the rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm.arrow import by_batch, cells, meet, runs
from tallyfold.llm.components import components
from tallyfold.session import stage

SHINGLE = 3
MAX_BITS = 3
SEED = 42
AGREE = 3

# Bits of each byte value, least first.
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of a text, 0 without words. A-Z count as a-z; words end at ASCII white space."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(p, seed) for p in parts), np.uint64)
    columns = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    ones = [np.bincount(columns[:, i], minlength=256) @ _BITS for i in range(8)]
    bits = np.concatenate(ones) * 2 > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, identity: str, text: str, shingle: int = SHINGLE) -> DataFrame:
    """(id, mark, fp) for every row; mark is a hash of the text, fp the fingerprint's 64 bits as a long."""
    rows = docs.select(_identity(identity), _mark(text), F.col(text).alias("text"))

    def work(batch: pa.RecordBatch) -> dict:
        values = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], np.uint64)
        return {"id": batch.column(0), "mark": batch.column(1), "fp": values.view(np.int64)}

    return by_batch(rows, work, "id long, mark long, fp long")


def _identity(identity: str) -> Column:
    return F.col(identity).cast("long").alias("id")


def _mark(text: str) -> Column:
    return F.xxhash64(text).alias("mark")


def _keys(fp: Column, max_bits: int) -> Column:
    """One (choice, bits) for every choice of blocks, the bits outside the choice set to 0."""
    edges = [round(64 * i / (max_bits + AGREE)) for i in range(max_bits + AGREE + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    signed = [sum(c) for c in combinations(masks, AGREE)]
    signed = [m - (1 << 64) if m >> 63 else m for m in signed]
    return F.array(
        *[
            F.struct(F.lit(i).cast("short").alias("choice"), fp.bitwiseAND(F.lit(m).cast("long")).alias("bits"))
            for i, m in enumerate(signed)
        ]
    )


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) that connect all values of `fps.fp` (distinct longs) within `max_bits` of each other.

    In each cell every member is linked to the least fingerprint it is connected with there; no group is expanded
    into all its pairs.
    """
    entries = fps.select("fp", F.explode(_keys(F.col("fp"), max_bits)).alias("k")).select("fp", "k.choice", "k.bits")
    laid = cells(entries, ["choice", "bits"], "fp")

    def compare(batches):
        for rows, starts in runs(batches, ["choice", "bits", "lo", "hi"]):
            fp, side = rows["fp"].to_numpy().view(np.uint64), rows["side"].to_numpy()
            same = rows["lo"].to_numpy() == rows["hi"].to_numpy()
            found_a, found_b = [], []
            for s, e in zip(starts, starts[1:]):
                if e - s < 2:
                    continue
                group = fp[s:e]
                cut = e - s if same[s] else int(np.searchsorted(side[s:e], 1))
                left, right = (group, group) if same[s] else (group[:cut], group[cut:])
                if not len(left) or not len(right):
                    continue
                near = np.bitwise_count(left[:, None] ^ right[None, :]) <= max_bits
                a, b = meet(near)
                both = np.concatenate([left, right])
                least = both[np.concatenate([a, b])]
                moved = least != both
                found_a.append(both[moved])
                found_b.append(least[moved])
            if found_a:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).view(np.int64)) for x in (found_a, found_b)], ["a", "b"]
                )

    return laid.select("choice", "bits", "lo", "hi", "side", "fp").mapInArrow(compare, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, identity: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row per row of `docs`: id, mark (a hash of the text), fp (long) and component, the least id reachable over
    links, itself included, and root, a name of the component (long).

    Null and empty texts have fingerprint 0 and link like any other. Rows with equal ids are rows of their own; a null
    id takes part but is no component's id unless the component has no other. Texts are taken whole. Other columns
    are ignored. No rows give no rows.
    """
    marked = stage(fingerprints(docs, identity, text, shingle), "fingerprints")
    values = marked.groupBy("fp").agg(F.min("id").alias("first"))
    roots = components(links(values.select("fp"), max_bits))
    # Only values with a link have a root; the others are their own component.
    rooted = values.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component"))
    labels = stage(rooted.join(least, "root").select("fp", "root", "component"), "labels")
    return marked.join(labels, "fp").select("id", "mark", "fp", "root", "component")


def keep_one(docs: DataFrame, identity: str = "doc_id", text: str = "text", **parameters) -> DataFrame:
    """The rows of `docs` without near-duplicates: of each component the row with the least id.

    Among rows of that id the least text hash stays, and of rows that also share their text one; null ids come last.
    """
    found = near_duplicates(docs, identity, text, **parameters)
    unnamed = F.col("id").isNull().alias("unnamed")
    first = F.min(F.struct(unnamed, F.coalesce("id", F.lit(0)).alias("id"), "mark"))
    kept = stage(found.groupBy("root").agg(first.alias("first")).select("first.*"), "kept")
    rows = docs.select(F.struct("*").alias("row"), _identity(identity), _mark(text))
    # Plain equality of keys without nulls: the join and the window share one shuffle of the texts.
    name = ["unnamed", "id", "mark"]
    rows = rows.select("row", unnamed, F.coalesce("id", F.lit(0)).alias("id"), "mark")
    order = Window.partitionBy(*name).orderBy(F.xxhash64("row"))
    single = rows.join(kept, name, "left_semi").withColumn("copy", F.row_number().over(order)).where("copy = 1")
    return single.select("row.*")
