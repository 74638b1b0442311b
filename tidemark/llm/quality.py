"""Quality scores by naive Bayes support vectors over n-gram indicators.

The n-grams are those of 1 to 3 bytes of the text, each hashed to one of BUCKETS numbers, and runs of 2 to 5 equal words,
whatever the word. The log-count ratios of the two classes are counted over all labelled rows. A linear
hinge-loss model is fitted by dual coordinate descent to indicators scaled by these ratios, on a sample of at most
`per_class` rows of each class (the rows with the smallest hashes); its weights are interpolated with their mean size.
A fifth of the sample is kept from the fit and sets the slope and offset that turn margins into probabilities.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidemark.llm.helpers import arrow_map
from tidemark.llm.words import slices, text_buffers, word_hashes

BITS = 16
BUCKETS = 1 << BITS
PER_CLASS = 6000
SMOOTHING = 1.0
MIXED = 0.25
PENALTY = 1.0
EPOCHS = 12

_LONGEST = 3
_FACTOR = np.uint32(0x9E3779B1)
#: Buckets 0 to 3 also stand for runs of 2 to 5 equal words.
_RUNS = 4


def indicators(texts: pa.Array):
    """For each text, the sorted buckets of its n-grams."""
    data, offsets = text_buffers(texts)
    words, bounds = word_hashes(data, offsets)
    runs = [np.concatenate([[False] * k, words[k:] == words[:-k]])[: len(words)] for k in (1,)]
    for k in range(1, _RUNS):  # equal to the word before, which ends a run of k words
        runs.append(np.concatenate([[False], runs[-1][:-1]])[: len(words)] & runs[0])
    codes = []
    rolled = np.zeros(len(data), dtype=np.uint32)
    for n in range(1, _LONGEST + 1):
        rolled[: len(data) - n + 1] = (rolled[: len(data) - n + 1] << np.uint32(8)) | data[n - 1 :]
        mixed = (rolled ^ (rolled >> np.uint32(15))) * _FACTOR + np.uint32(n)
        codes.append(((mixed ^ (mixed >> np.uint32(13))) * _FACTOR) >> np.uint32(32 - BITS))
    present = np.zeros(BUCKETS, dtype=bool)
    for d in range(len(offsets) - 1):
        a, b = offsets[d], offsets[d + 1]
        present[:] = False
        for n in range(_LONGEST):
            present[codes[n][a : max(a, b - n)]] = True
        for k in range(_RUNS):
            present[k] = runs[k][bounds[d] + k + 1 : bounds[d + 1]].any()
        yield np.flatnonzero(present)


def _class_counts(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """How many labelled rows of class 0 and 1 hold each bucket; BUCKETS rows at most reach the driver."""

    def work(batch: pa.RecordBatch):
        counts = np.zeros((2, BUCKETS), dtype=np.int64)
        for part in slices(batch, "text"):
            for label, found in zip(part.column("label").to_pylist(), indicators(part.column("text")), strict=True):
                counts[label, found] += 1
        some = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(counts[0, some]), pa.array(counts[1, some])], ["bucket", "low", "high"]
        )

    rows = arrow_map(labelled.select("label", "text"), work, "bucket long, low long, high long")
    counts = np.zeros((2, BUCKETS))
    for r in rows.groupBy("bucket").agg(F.sum("low").alias("low"), F.sum("high").alias("high")).collect():
        counts[:, r["bucket"]] = r["low"], r["high"]
    return counts[0], counts[1]


def log_ratios(low: np.ndarray, high: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    p, q = high + smoothing, low + smoothing
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_coordinate_descent(
    rows: list[np.ndarray], labels: np.ndarray, scale: np.ndarray, penalty: float = PENALTY, epochs: int = EPOCHS
) -> tuple[np.ndarray, float]:
    """Weights (of the scaled indicators, in rows of unit length) and offset of the linear hinge-loss model.

    Each step solves the dual problem exactly in one variable, whose box is larger for the rarer class.
    """
    signs = np.where(labels > 0, 1.0, -1.0)
    share = np.array([max((labels == c).mean(), 1e-9) for c in (0, 1)])
    box = penalty * 0.5 / share[labels]
    values = [scale[r] / max(np.linalg.norm(scale[r]), 1e-12) for r in rows]
    square = np.array([v @ v for v in values]) + 1.0  # 1 for the offset
    weights, offset, alpha = np.zeros(len(scale)), 0.0, np.zeros(len(rows))
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            gradient = signs[i] * (weights[rows[i]] @ values[i] + offset) - 1.0
            new = min(max(alpha[i] - gradient / square[i], 0.0), box[i])
            step = (new - alpha[i]) * signs[i]
            if step:
                weights[rows[i]] += step * values[i]
                offset += step
                alpha[i] = new
    return weights, offset


def _margins(rows: list[np.ndarray], scaled: np.ndarray, scale: np.ndarray, offset: float) -> np.ndarray:
    return np.array([scaled[r].sum() / max(np.linalg.norm(scale[r]), 1e-12) + offset for r in rows])


def _to_probability(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through margins, by Newton's steps; classes count alike."""
    weight = np.where(labels > 0, 0.5 / max((labels > 0).mean(), 1e-9), 0.5 / max((labels == 0).mean(), 1e-9))
    target = np.where(labels > 0, (np.sum(labels > 0) + 1) / (np.sum(labels > 0) + 2), 1 / (np.sum(labels == 0) + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g = weight * (p - target)
        h = weight * p * (1 - p)
        hess = np.array([[h @ margins**2 + 1e-6, h @ margins], [h @ margins, h.sum() + 1e-6]])
        step = np.linalg.solve(hess, [g @ margins, g.sum()])
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return (a, b) if a > 0 and math.isfinite(a + b) else (1.0, 0.0)


def _fit(rows: list[np.ndarray], labels: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, float]:
    """Weight of each bucket and offset, such that the logistic curve of their sum is the score."""
    if len(set(labels.tolist())) < 2:
        p = (labels.sum() + 1) / (len(labels) + 2)
        return np.zeros(len(scale)), math.log(p / (1 - p))
    kept = np.arange(len(rows)) % 5 == 4
    if len(set(labels[kept].tolist())) < 2 or len(set(labels[~kept].tolist())) < 2:
        kept[:] = False
    weights, offset = dual_coordinate_descent([r for r, k in zip(rows, kept, strict=True) if not k], labels[~kept], scale)
    weights = (1 - MIXED) * np.abs(weights).mean() + MIXED * weights if MIXED < 1 else weights
    judged = kept if kept.any() else ~kept
    margins = _margins([r for r, k in zip(rows, judged, strict=True) if k], weights * scale, scale, offset * MIXED)
    slope, base = _to_probability(margins, labels[judged])
    return weights * scale * slope, offset * MIXED * slope + base


class QualityModel:
    """Buckets' weights; small enough (BUCKETS numbers) to be sent along with each task."""

    def __init__(self, weights: np.ndarray, scale: np.ndarray, offset: float):
        self.weights, self.squares, self.offset = weights.astype(np.float32), (scale**2).astype(np.float32), offset

    def score(self, texts: pa.Array) -> np.ndarray:
        sums = [
            float(self.weights[r].sum(dtype=np.float64)) / math.sqrt(max(float(self.squares[r].sum(dtype=np.float64)), 1e-24))
            for r in indicators(texts)
        ]
        return 1 / (1 + np.exp(-np.clip(np.array(sums) + self.offset, -700, 700)))


def train_quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> QualityModel:
    """Learns from the rows of `labels` (doc_id, label 0 or 1) and the texts of `docs` with these ids.

    Rows without an id or with another label don't count; an id with both labels counts as 0. With no labelled row all
    scores are 0.5; with one class alone they are its smoothed share.
    """
    labels = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label"))
        .filter("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.min("label").alias("label"))
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Joined in the same way whatever the size of the labels, so that the cost follows the input.
    low, high = _class_counts(texts.join(labels.hint("merge"), "doc_id"))
    scale = log_ratios(low, high)
    chosen = [
        labels.filter(F.col("label") == c).orderBy(F.xxhash64(F.lit(11), "doc_id"), "doc_id").limit(per_class)
        for c in (0, 1)
    ]
    sample = F.broadcast(chosen[0].union(chosen[1]))  # 2 * per_class rows of two numbers at most

    def features(batch: pa.RecordBatch):
        for part in slices(batch, "text"):
            found = [r.astype("<u4").tobytes() for r in indicators(part.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("label"), pa.array(found, pa.binary())],
                ["doc_id", "label", "found"],
            )

    rows = arrow_map(texts.join(sample, "doc_id"), features, "doc_id long, label int, found binary")

    def fit(batches):
        table = pa.Table.from_batches(list(batches), pa.schema([("label", pa.int32()), ("found", pa.binary())]))
        found = [np.frombuffer(x, dtype="<u4") for x in table.column("found").to_pylist()]
        weights, offset = _fit(found, table.column("label").to_numpy().astype(np.int64), scale)
        yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()]), pa.array([offset])], ["weights", "offset"])

    ordered = rows.repartition(1).sortWithinPartitions(F.xxhash64(F.lit(13), "doc_id"), "doc_id", "found").select("label", "found")
    model = ordered.mapInArrow(fit, "weights binary, offset double").first()
    if model is None:
        return QualityModel(np.zeros(BUCKETS), scale, 0.0)
    return QualityModel(np.frombuffer(model["weights"]), scale, model["offset"])


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """Every column of `docs` and score: how likely label 1 is. Null and empty texts get the score of no n-gram."""
    name = "score"
    while name in docs.columns:
        name += "_"

    def work(batch: pa.RecordBatch):
        for part in slices(batch, "text"):
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(model.score(part.column("text")))], [*part.schema.names, name]
            )

    schema = StructType([*docs.schema.fields, StructField(name, DoubleType())])
    return arrow_map(docs, work, schema)
