"""Quality by Naive Bayes support vectors.

A text is a set of n-gram indicators: byte n-grams, and n-grams of word shapes by how often they occur (capitals, symbols,
digits, words just repeated). Each indicator is scaled by its class log-count ratio, texts are brought to length one, and a
linear hinge-loss model is fitted by dual coordinate descent. Scores come from a curve fitted to texts that the model was
not trained on.

Only texts and labels of the training rows enter. At most ``PER_CLASS`` labelled texts of each class are used for the
fit, whatever the table's size; all texts are scored, whole.

Defined results: a null text counts as empty, and a text without n-grams has margin 0; without training rows of both
classes every score is the share of good rows (0 without any); every row gets one score, repeated rows the same; an empty
table gives no rows; the columns of the input are kept, and a column ``score`` is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankflow.llm.batches import text_pieces, word_bounds, word_hashes
from bankflow.llm.labelled import calibrated, fold, labelled_sample, logistic

PER_CLASS = 1500
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7

BYTE_BITS = 16
BYTE_SIZES = (2, 3, 4)
SHAPES = 32
# Shares of a text's word pairs at which the indicator of a pair of shapes steps up.
LEVELS = (0.0, 0.02, 0.1, 0.3)
FEATURES = (1 << BYTE_BITS) + SHAPES * SHAPES * len(LEVELS)

SMOOTHING = 1.0
COST = 1.0
EPOCHS = 15
_SEED = 5
_BACK = 8


@dataclass(frozen=True)
class Model:
    ratios: np.ndarray
    weights: np.ndarray
    slope: float
    offset: float


def _shapes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Shape of every word, five bits: symbol, exclamation or question, no small letter, digit, repeated lately."""

    def holds(flags: np.ndarray) -> np.ndarray:
        total = np.zeros(len(data) + 1, np.int32)
        np.cumsum(flags, out=total[1:])
        return total[end] > total[begin]

    symbol = np.isin(data, np.frombuffer(b"#*$%&|<>{}=\\^~_", np.uint8))
    small = ((data >= 97) & (data <= 122)) | (data >= 0xC3)
    hashes = word_hashes(data, begin, end)
    row = np.searchsorted(before, np.arange(len(begin)), side="right")
    repeated = np.zeros(len(begin), bool)
    for back in range(1, min(_BACK, len(begin) - 1) + 1):
        repeated[back:] |= (hashes[back:] == hashes[:-back]) & (row[back:] == row[:-back])
    return (
        holds(symbol) + 2 * holds((data == 33) | (data == 63)) + 4 * ~holds(small)
        + 8 * holds((data >= 48) & (data <= 57)) + 16 * repeated
    ).astype(np.int64)


def indicators(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Row and the indices of its indicators."""
    seen = np.zeros(1 << BYTE_BITS, bool)
    for first, last, data, bounds in text_pieces(texts):
        begin, end, before = word_bounds(data, bounds)
        shapes = _shapes(data, begin, end, before)
        rolled, buckets = data.astype(np.uint32), []
        for n in range(2, max(BYTE_SIZES) + 1):
            rolled = rolled[:-1] * np.uint32(0x01000193) + data[n - 1 :] if len(rolled) else rolled
            buckets.append(((rolled ^ (rolled >> np.uint32(15))) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BYTE_BITS))
        for row in range(last - first):
            lo, hi = int(bounds[row]), int(bounds[row + 1])
            seen[:] = False
            for n, bucket in zip(range(2, max(BYTE_SIZES) + 1), buckets, strict=True):
                seen[bucket[lo : max(lo, hi - n + 1)]] = True
            found = [np.flatnonzero(seen)]
            own = shapes[before[row] : before[row + 1]]
            if len(own) > 1:
                pairs = np.bincount(own[:-1] * SHAPES + own[1:], minlength=SHAPES * SHAPES) / (len(own) - 1)
                for k, level in enumerate(LEVELS):
                    found.append(np.flatnonzero(pairs > level) + (1 << BYTE_BITS) + k * SHAPES * SHAPES)
            yield first + row, np.concatenate(found)


def margins(texts: pa.Array, ratios: np.ndarray, weights: np.ndarray) -> np.ndarray:
    out = np.zeros(len(texts))
    scaled, squared = ratios * weights, ratios**2
    for row, found in indicators(texts):
        out[row] = scaled[found].sum() / max(np.sqrt(squared[found].sum()), 1e-12)
    return out


def fit_weights(found: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-count ratios, then the hinge-loss model by dual coordinate descent (one multiplier per text)."""
    counts = [np.full(FEATURES, SMOOTHING), np.full(FEATURES, SMOOTHING)]
    for indices, label in zip(found, y, strict=True):
        counts[label][indices] += 1
    ratios = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    sign = np.where(y == 1, 1.0, -1.0)
    rows = []
    for indices in found:
        values = ratios[indices]
        norm = np.sqrt((values**2).sum())
        rows.append((indices, values / norm if norm > 0 else values))
    # Classes weigh the same, whatever their shares in the sample.
    bound = COST * len(y) / (2 * np.array([max(1, (y == label).sum()) for label in y]))
    weights, alpha, rng = np.zeros(FEATURES), np.zeros(len(y)), np.random.default_rng(_SEED)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(y)):
            indices, values = rows[i]
            gradient = sign[i] * (weights[indices] @ values) - 1
            updated = min(max(alpha[i] - gradient, 0.0), bound[i])
            if updated != alpha[i]:
                weights[indices] += (updated - alpha[i]) * sign[i] * values
                alpha[i] = updated
    return ratios, weights


def fit(texts: list[str], y: np.ndarray, share: float) -> Model:
    """Ratios and weights from three quarters of the texts, the curve from the others."""
    if len(set(y.tolist())) < 2:
        flat = float(np.log(share / (1 - share))) if 0 < share < 1 else (-35.0 if share == 0 else 35.0)
        return Model(np.zeros(FEATURES), np.zeros(FEATURES), 0.0, flat)
    turn = np.zeros(len(y), np.int64)
    for c in (0, 1):
        turn[y == c] = np.arange((y == c).sum())
    inner = turn % 4 != 3
    if len(set(y[~inner].tolist())) < 2:
        inner = np.ones(len(y), bool)
    found = [indices for _, indices in indicators(pa.array(texts, pa.large_string()))]
    ratios, weights = fit_weights([f for f, use in zip(found, inner, strict=True) if use], y[inner])
    judged = ~inner if not inner.all() else inner
    held = margins(
        pa.array([t for t, use in zip(texts, judged, strict=True) if use], pa.large_string()), ratios, weights)
    slope, offset = calibrated(held, y[judged], share)
    return Model(ratios, weights, slope, offset)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> Model:
    return fit(*labelled_sample(docs, labels, label, per_class))


def training_rows(labels: DataFrame) -> DataFrame:
    return labels.filter(fold(F.col("doc_id"), FOLDS) != HELD_OUT)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds ``score``, 0 to 1. One pass over the scan: no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(vars(model).values()))
    kept = [f for f in docs.schema.fields if f.name != "score"]
    names = [f.name for f in kept]
    source = docs.select(*(F.col(f"`{n}`") for n in names), F.coalesce(F.col(text), F.lit("")).alias("_scored_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value)
        for batch in batches:
            scores = logistic(m.slope * margins(batch.column(len(names)), m.ratios, m.weights) + m.offset)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(scores)], [*names, "score"])

    return source.mapInArrow(run, T.StructType([*kept, T.StructField("score", T.DoubleType())]))


def quality_model_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(docs, training_rows(labels))
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
