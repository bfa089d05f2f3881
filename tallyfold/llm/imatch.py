"""I-Match fingerprints.

The terms of a text whose inverse document frequency lies within a band are kept: words that many texts have say
little, words that hardly any text has are noise. A fingerprint holds one hash for each of several random subsets of
the lexicon: the hash of the sorted distinct terms of the text that lie in the subset. Two texts agree in a subset if
they have the same terms there.

Subsets come in several densities. Those with half of the lexicon agree for copies alone; sparse ones, in which a text
has a term or two, survive an edit as often as the texts share terms. The likeness of two fingerprints is the greatest
share of agreeing subsets over the densities, among subsets in which one of the texts has a term.

The band is stated in document frequencies relative to the number of texts. As each text has so many distinct terms,
at most (mean terms per text) / `RARE` terms are frequent enough: the lexicon has a bounded size at any corpus size,
which is why it may be broadcast.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm.arrow import by_batch
from tallyfold.session import stage

COMMON = 0.2  # terms in a greater share of the texts are left out
RARE = 0.0002  # and those in a smaller share
DENSITIES = tuple(4.0**-i for i in range(1, 6))
COPIES = 16  # subsets of each density
FEWEST = 5  # subsets with a term, for a density to count
DIGITS = 6  # hexadecimal digits of a subset's hash
EMPTY = "0" * DIGITS
BUCKET = 8192  # neighbouring texts that are handled together
SEED = 42

_NULL = -(1 << 63)  # stands for a null id, before all others
_TERM = re.compile(r"\w+")
_MULTIPLIERS = np.random.default_rng(SEED).integers(1 << 62, (1 << 63) - 1, len(DENSITIES) * COPIES, np.uint64) * 2 + 1
_LIMITS = np.repeat([np.uint64(int(d * 2**64) - 1) for d in DENSITIES], COPIES)


def terms(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the lower-case words."""
    words = set(_TERM.findall((text or "").lower()))
    digest = xxhash.xxh3_64_intdigest
    hashes = np.fromiter((digest(w.encode()) for w in words), np.uint64, len(words))
    hashes.sort()
    return hashes


def lexicon(docs: DataFrame, text: str, common: float = COMMON, rare: float = RARE) -> np.ndarray:
    """Sorted hashes of the terms whose document frequency lies in the band; see above for its bounded size.

    In a small corpus a term needs no second text: the least frequency is one text.
    """

    def count(batches):
        # What a task has seen is summed up and sent on whenever it gets large, so memory stays bounded.
        seen, size, rows = [], 0, 0
        for batch in batches:
            rows += batch.num_rows
            for t in batch.column(0):
                seen.append(terms(t.as_py()))
                size += len(seen[-1])
                if size > 2_000_000:
                    yield _counted(seen, rows)
                    seen, size, rows = [], 0, 0
        yield _counted(seen, rows)

    counts = docs.select(F.col(text).alias("text")).mapInArrow(count, "term long, n long")
    frequencies = counts.groupBy("term").agg(F.sum("n").alias("n"))
    total = docs.count()
    band = frequencies.where(F.col("term").isNotNull() & (F.col("n") >= rare * total) & (F.col("n") <= max(common * total, 1)))
    rows = band.select("term").toArrow()["term"].to_numpy()
    return np.sort(rows.view(np.uint64))


def _counted(seen: list[np.ndarray], rows: int) -> pa.RecordBatch:
    values, n = np.unique(np.concatenate([*seen, np.zeros(0, np.uint64)]), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n)], ["term", "n"])


def fingerprint(found: np.ndarray, words: np.ndarray) -> str:
    """The hashes of all subsets, a few hexadecimal digits each, for the terms of a text.

    Subsets without a term of the text have zeros. A text without a term in the lexicon has the hash of all its terms
    in every subset, so that copies agree.
    """
    if not len(found):
        return EMPTY * len(_LIMITS)
    at = np.searchsorted(words, found)
    at[at == len(words)] = 0
    kept = found[words[at] == found] if len(words) else found[:0]
    if not len(kept):
        return _hash(found.tobytes()) * len(_LIMITS)
    # A term is in a subset if its hash under the subset's multiplier is below the density.
    mixed = kept[:, None] * _MULTIPLIERS
    mixed ^= mixed >> np.uint64(32)
    mixed *= _MULTIPLIERS
    subset, member = np.nonzero((mixed <= _LIMITS).T)
    members = kept[member].tobytes()
    edges = (8 * np.searchsorted(subset, np.arange(len(_LIMITS) + 1))).tolist()
    return "".join(_hash(members[a:b]) if a < b else EMPTY for a, b in zip(edges, edges[1:]))


def _hash(members: bytes) -> str:
    return f"{xxhash.xxh3_64_intdigest(members, SEED) % (16**DIGITS - 1) + 1:0{DIGITS}x}"


def likeness(a: str, b: str) -> float:
    """From 0 to 1; 1 for equal fingerprints."""
    if a == b:
        return 1.0
    x, y = (np.frombuffer(f.encode(), f"S{DIGITS}").reshape(-1, COPIES) for f in (a, b))
    used = ((x != EMPTY.encode()) | (y != EMPTY.encode())).sum(1)
    agree = ((x == y) & (x != EMPTY.encode())).sum(1)
    shares = agree[used >= FEWEST] / used[used >= FEWEST]
    return float(max(shares.max(initial=0), agree.sum() / max(used.sum(), 1)))


def fingerprints(docs: DataFrame, identity: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, fingerprint) for every row of `docs`, `row` being all its columns as a struct.

    Texts are read whole; a null text counts as an empty one. Equal texts have equal fingerprints. No rows give no rows.
    """
    words = docs.sparkSession.sparkContext.broadcast(lexicon(docs, text))
    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))

    def work(batch: pa.RecordBatch) -> dict:
        return {
            "row": batch.column(0),
            "fingerprint": [fingerprint(terms(t.as_py()), words.value) for t in batch.column(1)],
        }

    return by_batch(rows, work, f"row {docs.schema.simpleString()}, fingerprint string")


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the following text."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def _starts(docs: DataFrame, identity: str) -> np.ndarray:
    """Ids at which buckets start: each bucket has at most `BUCKET` ids, which are neighbours in order."""
    ids = docs.select(F.coalesce(F.col(identity).cast("long"), F.lit(_NULL)).alias("id"))
    laid = stage(ids.repartitionByRange("id").withColumn("part", F.spark_partition_id()), "ids")
    place = F.row_number().over(Window.partitionBy("part").orderBy("id"))
    starts = laid.withColumn("place", place).where((F.col("place") - 1) % BUCKET == 0).select("id").distinct()
    return np.sort(starts.toArrow()["id"].to_numpy())


def edit_likeness(docs: DataFrame, identity: str = "doc_id", text: str = "text") -> DataFrame:
    """How fingerprints bear an edit: each text against its edited self and against the next text.

    The next text is that of the next id, after the last the first; a null id comes before all others, and equal ids
    are ordered by a hash of their text. Columns: id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. A null text counts as an empty one. No rows give no rows.

    Texts are dealt, compressed, into buckets of neighbouring ids; the first row of a bucket goes to the bucket before
    it too. The starts of the buckets, one id for `BUCKET` rows, are all that the driver learns of the order.
    """
    context = docs.sparkSession.sparkContext
    words = context.broadcast(lexicon(docs, text))
    starts = context.broadcast(_starts(docs, identity))
    rows = docs.select(
        F.coalesce(F.col(identity).cast("long"), F.lit(_NULL)).alias("id"),
        F.xxhash64(text).alias("turn"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )

    def deal(batch: pa.RecordBatch) -> dict:
        ids, turns = (batch.column(i).to_numpy() for i in (0, 1))
        bucket = np.searchsorted(starts.value, ids, side="right") - 1
        first = np.flatnonzero(starts.value[bucket] == ids)
        squeeze = zstandard.ZstdCompressor(level=1).compress
        packed = [squeeze(t.as_py().encode()) for t in batch.column(2)]
        return {
            "bucket": np.concatenate([bucket, (bucket[first] - 1) % len(starts.value)]),
            "guest": np.repeat([False, True], [len(ids), len(first)]),
            "id": np.concatenate([ids, ids[first]]),
            "turn": np.concatenate([turns, turns[first]]),
            "packed": packed + [packed[i] for i in first],
        }

    dealt = by_batch(rows, deal, "bucket long, guest boolean, id long, turn long, packed binary")
    laid = dealt.repartition("bucket").sortWithinPartitions("bucket", "guest", "id", "turn")

    def compare(batches):
        open_text = zstandard.ZstdDecompressor().decompress
        held = None  # the row whose next text is still to come, and its bucket
        out: list[tuple] = []
        for batch in batches:
            columns = (batch.column(n) for n in ("bucket", "guest", "id", "packed"))
            for bucket, guest, number, packed in zip(*(c.to_pylist() for c in columns)):
                if held and held[0] == bucket and held[1] is None:
                    continue  # further rows of the guest's id
                now = open_text(packed).decode()
                print_now = fingerprint(terms(now), words.value)
                if held and held[0] == bucket:
                    _, name, old, print_old = held
                    new = edited(old, now)
                    print_new = fingerprint(terms(new), words.value)
                    digest = hashlib.sha256(new.encode()).hexdigest()
                    near = likeness(print_old, print_new), likeness(print_old, print_now)
                    out.append((None if name == _NULL else name, len(old), digest, print_old, print_new, *near))
                held = (bucket, None if guest else number, now, print_now)
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _OUT)], schema=_OUT)
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _OUT)], schema=_OUT)

    kinds = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string"
    return laid.select("bucket", "guest", "id", "packed").mapInArrow(compare, kinds + ", near_edited double, near_next double")


_OUT = pa.schema(
    [("id", pa.int64()), ("n_chars", pa.int64())]
    + [(n, pa.string()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")]
    + [(n, pa.float64()) for n in ("near_edited", "near_next")]
)
