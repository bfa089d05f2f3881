"""Quality classifier by compression.

Two zstandard dictionaries are built, from text labelled good and text labelled bad. A text that compresses better
with the good dictionary resembles good text: (bad size - good size) / (bad size + good size) is its normalised
difference. A calibration, fitted on other labelled rows, turns it into a probability. How much the difference tells
depends on how far the text compresses at all and on its length (both dictionaries shrink a repeated line to nothing),
so the calibration reads these two sizes beside it; it uses the compressed sizes and nothing else.

Training uses at most `ROWS` labelled rows of each class, those with the least hash of their id among the rows open
to training, so reruns learn the same. That is the only sample; every row is scored on its whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.arrow import by_batch

ROWS = 2500  # of each class
LONGEST = 20_000  # code points; longer texts are no training rows
DICTIONARY = 112_640  # bytes of each dictionary
PIECE = 2_000  # bytes of a training sample inside a text
LEVEL = 3
SEED = 42
SHRINK = 0.1  # ridge penalty of the calibration

_KNOTS = (0.05, 0.15, 0.3, 0.5, 0.7, 0.85, 0.95)


def held_out(identity: Column) -> Column:
    """Rows kept from training: crc32 of the id as text is divisible by 5. A null id is one of them."""
    return F.coalesce(F.crc32(identity.cast("string").cast("binary")) % 5 == 0, F.lit(True))


@dataclass
class Model:
    """Dictionaries and calibration; a few hundred KB, whatever the corpus."""

    good: bytes
    bad: bytes
    knots: np.ndarray
    weights: np.ndarray

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not len(self.weights):
            return np.full(len(texts), 0.5)
        return _logistic(_basis(self.sizes(texts), self.knots) @ self.weights)

    def sizes(self, texts: list[str | None]) -> np.ndarray:
        """Compressed with the good and the bad dictionary, and uncompressed, in bytes."""
        good, bad = _compressor(self.good), _compressor(self.bad)
        rows = []
        for text in texts:
            data = (text or "").encode()
            rows.append((len(good.compress(data)), len(bad.compress(data)), len(data)))
        return np.array(rows, float).reshape(-1, 3)


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=data, write_content_size=False, write_dict_id=False, write_checksum=False
    )


def _dictionary(texts: list[str]) -> bytes:
    """Trained on pieces of the texts; text itself where there is too little to train on."""
    pieces = [data[i : i + PIECE] for data in (t.encode() for t in texts) for i in range(0, len(data), PIECE)]
    try:
        return zstandard.train_dictionary(DICTIONARY, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-DICTIONARY:] or b" " * 8


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _columns(sizes: np.ndarray) -> np.ndarray:
    good, bad, plain = sizes.T
    return np.stack([(bad - good) / (bad + good), np.log((good + bad + 20) / (2 * plain + 20)), np.log(plain + 20)], 1)


def _basis(sizes: np.ndarray, knots: np.ndarray) -> np.ndarray:
    """Piecewise linear terms of the difference, the ratio and the length, and their products."""
    columns = _columns(sizes)
    scale = np.maximum(knots[-1] - knots[0], 1e-9)
    scaled = np.clip((columns - knots[0]) / scale, -2, 3)
    hinges = [np.clip((columns - k) / scale, 0, 3) for k in knots]
    products = scaled[:, [0, 0, 1]] * scaled[:, [1, 2, 2]]
    return np.concatenate([np.ones((len(columns), 1)), scaled, *hinges, products], 1)


def _fit(terms: np.ndarray, labels: np.ndarray, row_weights: np.ndarray) -> np.ndarray:
    """Logistic regression with a ridge penalty, by Newton's method."""
    weights = np.zeros(terms.shape[1])
    penalty = SHRINK * np.eye(terms.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(60):
        p = _logistic(terms @ weights)
        curve = np.maximum(p * (1 - p), 1e-6) * row_weights
        step = np.linalg.solve(
            (terms * curve[:, None]).T @ terms + penalty, terms.T @ (row_weights * (labels - p)) - penalty @ weights
        )
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def train(docs: DataFrame, labels: DataFrame, identity: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """The model learned from labelled rows that are not held out.

    Half of each class builds its dictionary, the other half fits the calibration, weighted to the share that the
    classes have among all labelled training rows. Rows with a null or another label, without text, or whose text is
    too long do not train; of texts with one id the least does. Without rows of both classes every score is 0.5.
    """
    known = (
        labels.select(F.col(identity).alias("id"), F.col(label).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & ~held_out(F.col("id")))
        .dropDuplicates(["id"])
    )
    share = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    turn = F.xxhash64("id", F.lit(SEED))
    chosen = None
    for value in (0, 1):
        # Somewhat more than needed, as long texts drop out; both numbers are bounds.
        rows = known.where(F.col("label") == value).withColumn("turn", turn)
        part = 4 * ROWS / max(share.get(value, 0), 1)
        if part < 1:
            # The least hashes are in this part of their range; no task offers the driver many more than are taken.
            rows = rows.where(F.col("turn") < int(part * (1 << 64)) - (1 << 63))
        rows = rows.orderBy("turn", "id").limit(2 * ROWS)
        chosen = rows if chosen is None else chosen.unionByName(rows)
    texts = docs.select(F.col(identity).alias("id"), F.col(text).alias("text")).where(
        F.col("text").isNotNull() & (F.length("text") <= LONGEST)
    )
    # Rows may share an id, any number of them.
    one = texts.join(F.broadcast(chosen), "id").groupBy("id", "label", "turn").agg(F.min("text").alias("text"))
    samples = {0: [], 1: []}
    for row in sorted(one.collect(), key=lambda r: (r["turn"], r["id"], r["text"])):
        if len(samples[row["label"]]) < ROWS:
            samples[row["label"]].append(row["text"])
    if min(len(samples[0]), len(samples[1])) < 2:
        return Model(b"", b"", np.zeros(0), np.zeros(0))
    built, judged = ({v: rows[i::2] for v, rows in samples.items()} for i in (0, 1))
    model = Model(_dictionary(built[1]), _dictionary(built[0]), np.zeros(0), np.zeros(0))
    sizes = model.sizes(judged[1] + judged[0])
    truth = np.repeat([1.0, 0.0], [len(judged[1]), len(judged[0])])
    total = share[0] + share[1]
    weigh = np.where(truth == 1, share[1] / len(judged[1]), share[0] / len(judged[0])) * len(truth) / total
    model.knots = np.quantile(_columns(sizes), _KNOTS, axis=0)
    model.weights = _fit(_basis(sizes, model.knots), truth, weigh)
    return model


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """(row, score): every row of `docs` as a struct, and the chance that its text is good, from 0 to 1.

    A null text is scored as an empty one. Texts are read whole. No rows give no rows.
    """
    kept = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    schema = f"row {docs.schema.simpleString()}, score double"

    def work(batch: pa.RecordBatch) -> dict:
        return {"row": batch.column(0), "score": model.scores([t.as_py() for t in batch.column(1)])}

    return by_batch(kept, work, schema)


def keep_good(docs: DataFrame, model: Model, least: float, text: str = "text") -> DataFrame:
    """The rows of `docs` that score at least `least`."""
    return score(docs, model, text).where(F.col("score") >= least).select("row.*")
