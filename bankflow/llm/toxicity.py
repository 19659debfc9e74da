"""Toxicity by subword bags.

The words of a window are a bag of character n-grams (UTF-8 bytes, word ends included, A to Z in lower case). N-gram
vectors are averaged into a linear softmax, and vectors and softmax are trained jointly in numpy, so a misspelling that
was never seen shares most of its vectors with the word it stands for. A window is scored, not the text as one bag: a few
words among thousands would vanish in the average. A text scores by its most toxic window, on a curve fitted to texts
that the vectors were not trained on.

Only texts and labels of the training rows enter. At most ``PER_CLASS`` labelled texts of each class are used for the
fit, whatever the table's size; all texts are scored, whole.

Defined results: a null text counts as empty; a text without words scores like a window without n-grams; without training
rows of both classes every score is the share of toxic rows (0 without any); every row gets one score, repeated rows the
same; an empty table gives no rows; the columns of the input are kept, and a column ``score`` is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankflow.llm.batches import text_pieces
from bankflow.llm.labelled import calibrated, fold, labelled_sample, logistic

PER_CLASS = 800
FOLDS, HELD_OUT = 5, 0

WINDOW = 2
TOP = 3
SIZES = (3, 4, 5, 6)
BUCKET_BITS = 17
DIMENSIONS = 8
EPOCHS = 4
RATE = 0.3
_BATCH = 512
_SEED = 11


@dataclass(frozen=True)
class Model:
    """What scoring needs of the vectors: each n-gram's share of the logit, and the curve over the largest window."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float


def _grams(data: np.ndarray, bounds: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """``[(bucket, word), ..]`` per n-gram size, and the words before each row. Blanks mark word ends."""
    text = np.insert(data, bounds, 32)
    text = np.where((text >= 9) & (text <= 13), np.uint8(32), text)
    text = text + ((text >= 65) & (text <= 90)) * np.uint8(32)
    blank = text == 32
    starts = ~blank[1:] & blank[:-1]
    word = np.zeros(len(text), np.int32)
    np.cumsum(starts, out=word[1:])
    blanks_before = np.zeros(len(text) + 1, np.int32)
    np.cumsum(blank, out=blanks_before[1:])
    at_row = bounds + np.arange(len(bounds))
    before = word[at_row]
    rolled = text.astype(np.uint32)
    out = []
    for n in range(2, max(SIZES) + 1):
        rolled = rolled[:-1] * np.uint32(0x01000193) + text[n - 1 :]
        if n not in SIZES:
            continue
        count = len(rolled)
        inside = blanks_before[n - 1 : n - 1 + count] - blanks_before[1 : 1 + count]
        at = np.flatnonzero(inside == 0)
        bucket = ((rolled[at] ^ (rolled[at] >> np.uint32(15))) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BUCKET_BITS)
        out.append((bucket, word[at + 1] - 1))
    return out, before


def likeliest_windows(texts: pa.Array, weights: np.ndarray, bias: float) -> np.ndarray:
    """Mean logit of the ``TOP`` most toxic windows of every text (of all, where it has fewer)."""
    out = np.full(len(texts), bias)
    for first, last, data, bounds in text_pieces(texts):
        grams, before = _grams(data, bounds)
        n = int(before[-1])
        summed, counted = np.zeros(n), np.zeros(n)
        for bucket, word in grams:
            summed += np.bincount(word, weights[bucket], n)[:n]
            counted += np.bincount(word, minlength=n)[:n]
        for row in range(last - first):
            lo, hi = before[row], before[row + 1]
            if hi > lo:
                at = np.arange(0, hi - lo, WINDOW)
                counts = np.maximum(np.add.reduceat(counted[lo:hi], at), 1)
                logits = np.add.reduceat(summed[lo:hi], at) / counts
                if len(logits) > TOP:
                    logits = np.partition(logits, len(logits) - TOP)[-TOP:]
                out[first + row] = bias + logits.mean()
    return out


def _bags(texts: list[str], y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows side by side: n-gram buckets, where each window begins, its label and its text."""
    buckets, sizes, labels, owners = [], [], [], []
    for first, last, data, bounds in text_pieces(pa.array(texts, pa.large_string())):
        grams, before = _grams(data, bounds)
        bucket = np.concatenate([b for b, _ in grams])
        word = np.concatenate([w for _, w in grams])
        row_of = np.searchsorted(before, np.arange(int(before[-1])), side="right") - 1
        in_row = np.arange(int(before[-1])) - before[row_of]
        windows_before = np.zeros(last - first + 1, np.int64)
        np.cumsum(-(-np.diff(before) // WINDOW), out=windows_before[1:])
        window = (windows_before[row_of] + in_row // WINDOW)[word] if len(word) else np.zeros(0, np.int64)
        order = np.argsort(window, kind="stable")
        buckets.append(bucket[order])
        sizes.append(np.bincount(window, minlength=int(windows_before[-1])))
        owner = np.repeat(np.arange(first, last), np.diff(windows_before))
        owners.append(owner)
        labels.append(y[owner])
    sizes = np.concatenate(sizes)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    return np.concatenate(buckets), begin, np.concatenate(labels), np.concatenate(owners)


def _gather(buckets: np.ndarray, begin: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    counts = begin[chosen + 1] - begin[chosen]
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    at = np.repeat(begin[chosen] - starts, counts) + np.arange(counts.sum())
    return buckets[at], counts


def fit_vectors(texts: list[str], y: np.ndarray) -> tuple[np.ndarray, float]:
    """Joint training of n-gram vectors and softmax. From the middle on, a toxic text teaches by its most toxic windows
    only: most of its windows are as clean as any."""
    rng = np.random.default_rng(_SEED)
    vectors = rng.normal(0, 0.05, (1 << BUCKET_BITS, DIMENSIONS)).astype(np.float32)
    softmax = rng.normal(0, 0.5, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen_v, seen_s, seen_b = np.full_like(vectors, 1e-8), np.full_like(softmax, 1e-8), np.full_like(bias, 1e-8)
    buckets, begin, labels, owners = _bags(texts, y)
    usable = np.flatnonzero(np.diff(begin) > 0)
    for epoch in range(EPOCHS):
        chosen = usable
        if epoch >= EPOCHS // 2:
            weights = vectors @ (softmax[:, 1] - softmax[:, 0])
            logit = np.add.reduceat(weights[buckets], begin[usable]) / np.diff(begin)[usable]
            # Rank of a window inside its text, from the most toxic down.
            order = np.lexsort((-logit, owners[usable]))
            ranks = np.empty(len(usable), np.int64)
            firsts = np.searchsorted(owners[usable][order], owners[usable][order])
            ranks[order] = np.arange(len(usable)) - firsts
            held = np.bincount(owners[usable], minlength=len(y))[owners[usable]]
            chosen = usable[(labels[usable] == 0) | (ranks < np.maximum(2, held // 20))]
        for part in np.array_split(rng.permutation(chosen), max(1, len(chosen) // _BATCH)):
            ids, counts = _gather(buckets, begin, part)
            bag = np.add.reduceat(vectors[ids], np.concatenate([[0], np.cumsum(counts)[:-1]]), axis=0)
            bag /= counts[:, None]
            logits = bag @ softmax + bias
            logits -= logits.max(1, keepdims=True)
            error = np.exp(logits)
            error /= error.sum(1, keepdims=True)
            error[np.arange(len(part)), labels[part]] -= 1
            back = (error @ softmax.T) / counts[:, None]
            for value, seen, gradient in ((softmax, seen_s, bag.T @ error / len(part)), (bias, seen_b, error.mean(0))):
                seen += gradient**2
                value -= RATE * gradient / np.sqrt(seen)
            used, place = np.unique(ids, return_inverse=True)
            window = np.repeat(np.arange(len(part)), counts)
            gradient = np.column_stack([
                np.bincount(place, back[window, k], len(used)) for k in range(DIMENSIONS)]).astype(np.float32)
            seen_v[used] += gradient**2
            vectors[used] -= RATE * 0.3 * gradient / np.sqrt(seen_v[used])
    return (vectors @ (softmax[:, 1] - softmax[:, 0])).astype(np.float32), float(bias[1] - bias[0])


def fit(texts: list[str], y: np.ndarray, share: float) -> Model:
    """Vectors from three quarters of the texts, the curve from the others."""
    flat = Model(np.zeros(1 << BUCKET_BITS, np.float32), 0.0, 0.0,
                 float(np.log(share / (1 - share))) if 0 < share < 1 else (-35.0 if share == 0 else 35.0))
    if len(set(y.tolist())) < 2:
        return flat
    turn = np.zeros(len(y), np.int64)
    for c in (0, 1):
        turn[y == c] = np.arange((y == c).sum())
    inner = turn % 4 != 3
    if len(set(y[~inner].tolist())) < 2:
        inner = np.ones(len(y), bool)
    weights, bias = fit_vectors([t for t, use in zip(texts, inner, strict=True) if use], y[inner])
    judged = ~inner if not inner.all() else inner
    margins = likeliest_windows(pa.array([t for t, use in zip(texts, judged, strict=True) if use], pa.large_string()),
                              weights, bias)
    slope, offset = calibrated(margins, y[judged], share)
    return Model(weights, bias, slope, offset)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS) -> Model:
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
            margins = likeliest_windows(batch.column(len(names)), m.weights, m.bias)
            scores = pa.array(logistic(m.slope * margins + m.offset))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], scores], [*names, "score"])

    return source.mapInArrow(run, T.StructType([*kept, T.StructField("score", T.DoubleType())]))


def toxicity_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(docs, training_rows(labels))
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
