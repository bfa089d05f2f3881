"""Best-fit packing into sequences of several permitted lengths.

Rows are dealt into shards of bounded size by a hash, and each shard is packed on its own; only ids and lengths move.
Within a shard pieces go, longest first, into the open bin with the least room that still holds them. If none does, a
bin is opened: for each permitted length the bin is filled in thought with the pieces still to come, and the length
with the least cost per word of content is taken, the filled bin being priced at the shortest length that holds it.
At the end each bin shrinks to the shortest permitted length that holds its contents.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.arrow import runs
from tallyfold.session import stage

LENGTHS = (512, 1024, 2048, 4096, 8192)
OVERHEAD = 16  # cost of a bin besides its length, in words
SHARD_ROWS = 4096
SEED = 42


def cost(length: int, overhead: int = OVERHEAD) -> int:
    return length + overhead


class _Stock:
    """Lengths still to be packed, with their counts; answers which is the longest that fits."""

    def __init__(self, lengths: np.ndarray):
        values, counts = np.unique(lengths, return_counts=True)
        self.values, self.count = values.tolist(), dict(zip(values.tolist(), counts.tolist()))

    def take(self, length: int) -> None:
        self.count[length] -= 1
        if not self.count[length]:
            del self.values[bisect_left(self.values, length)]

    def fill(self, room: int) -> int:
        """Room left after filling `room` greedily, longest first."""
        at = len(self.values)
        while at and room:
            at = bisect_right(self.values, room, 0, at)
            if not at or not self.values[at - 1]:
                break
            value = self.values[at - 1]
            room -= value * min(self.count[value], room // value)
            at -= 1
        return room


def pack(pieces: np.ndarray, lengths: tuple[int, ...] = LENGTHS, overhead: int = OVERHEAD) -> tuple[np.ndarray, np.ndarray]:
    """Bin number of each piece (lengths descending, none above the longest permitted), and the length of each bin."""
    lengths = tuple(sorted(lengths))
    stock = _Stock(pieces)
    room: list[tuple[int, int]] = []  # (room, bin), ascending
    used: list[int] = []
    bins = np.empty(len(pieces), np.int64)
    for i, piece in enumerate(pieces.tolist()):
        stock.take(piece)
        at = bisect_left(room, (piece, -1))
        if at < len(room):
            left, number = room.pop(at)
        else:
            best = None
            for length in lengths[bisect_left(lengths, piece) :]:
                full = length - stock.fill(length - piece)
                price = cost(lengths[bisect_left(lengths, full)], overhead) / max(full, 1)
                if best is None or price < best[0]:
                    best = (price, length)
            left, number = best[1], len(used)
            used.append(0)
        bins[i] = number
        used[number] += piece
        insort(room, (left - piece, number))
    final = [lengths[bisect_left(lengths, u)] for u in used]
    return bins, np.array(final, np.int64)


def pieces_of(docs: DataFrame, identity: str, size: Column, longest: int, text: str | None = None) -> DataFrame:
    """(id, size, piece, start, words, text): rows longer than `longest` are cut, the last piece is the rest.

    A row without words is one piece of length 0. The text is the piece's own, null where none is asked for.
    """
    rows = docs.select(
        F.col(identity).cast("long").alias("id"),
        F.coalesce(size, F.lit(0)).cast("long").alias("size"),
        (F.col(text) if text else F.lit(None).cast("string")).alias("text"),
    )
    cuts = F.greatest(F.ceil(F.col("size") / F.lit(longest)).cast("long"), F.lit(1).cast("long"))
    cut = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), cuts - 1)))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))
    own = F.array_join(F.slice(words, (F.col("start") + 1).cast("int"), F.lit(longest)), "")
    return (
        cut.withColumn("start", F.col("piece") * longest)
        .withColumn("words", F.least(F.col("size") - F.col("start"), F.lit(longest).cast("long")))
        .withColumn("text", F.when(F.col("size") > longest, own).otherwise(F.col("text")))
    )


def best_fit(
    docs: DataFrame,
    identity: str,
    size: Column,
    text: str | None = None,
    lengths: tuple[int, ...] = LENGTHS,
    overhead: int = OVERHEAD,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """One row per piece: id, size, piece, start, words, bin (a name), bin_length, bin_used, position (where it starts).

    Sizes count words; null counts as 0. Pieces without words go to a bin like others. Rows with equal ids are rows of
    their own, a null id stays null. Every word is in exactly one bin, and no bin holds more than its length. The
    result depends on ids and sizes alone. With `text`, the column `text` holds the piece's text. No rows give no rows.
    """
    longest = max(lengths)
    slim = stage(pieces_of(docs, identity, size, longest).drop("text"), "pieces")
    shards = max(-(-slim.count() // shard_rows), 1)
    pieces = pieces_of(docs, identity, size, longest, text) if text else slim
    carried = ["id", "size", "piece", "start", "words"] + ["text"] * bool(text)
    shard = F.pmod(F.xxhash64(F.lit(SEED), F.col("id"), F.col("piece"), F.col("size")), F.lit(shards))
    dealt = pieces.select(*carried, shard.alias("shard"))
    laid = dealt.repartition("shard").sortWithinPartitions(
        "shard", F.col("words").desc(), F.col("id").asc_nulls_first(), "piece", "size"
    )

    def work(batches):
        for rows, starts in runs(batches, ["shard"]):
            words, number = rows["words"].to_numpy(), rows["shard"].to_numpy()
            names, columns = [], ([], [], [])
            for s, e in zip(starts, starts[1:]):
                bins, final = pack(words[s:e], lengths, overhead)
                order = np.argsort(bins, kind="stable")
                held = words[s:e][order]
                before = np.cumsum(held) - held
                first = np.searchsorted(bins[order], np.arange(len(final)))
                position = np.empty(e - s, np.int64)
                position[order] = before - before[first][bins[order]]
                used = np.bincount(bins, weights=words[s:e], minlength=len(final)).astype(np.int64)
                names += [f"{number[s]}-{b}" for b in bins]
                for column, values in zip(columns, (final[bins], used[bins], position)):
                    column.append(values)
            arrays = [rows[c].combine_chunks() for c in carried]
            arrays += [pa.array(names), *(pa.array(np.concatenate(c)) for c in columns)]
            yield pa.RecordBatch.from_arrays(arrays, [*carried, "bin", "bin_length", "bin_used", "position"])

    kinds = ", ".join(f"{c} {'string' if c == 'text' else 'long'}" for c in carried)
    return laid.mapInArrow(work, kinds + ", bin string, bin_length long, bin_used long, position long")
