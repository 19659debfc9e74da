"""The scorers and the fit of the two classifiers against plain forms, text by text and word by word."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest

from bankflow.llm import quality_model, toxicity
from tests.llm.test_operators import prose

TEXTS = [
    "", " \t\n ", "one", "A b", "Mixed CASE and tabs\there,\nnew lines; é ü ß 12 times!", "x" * 400, "no no no no ### |$ NO!",
    " ".join(prose(1, 90)), " ".join(prose(2, 33)) + "\n" + " ".join(prose(3, 5)), "é" * 7 + " " + "ü " * 40,
]


def rolled(data: bytes, bits: int) -> int:
    value = data[0]
    for byte in data[1:]:
        value = (value * 0x01000193 + byte) % 2**32
    return ((value ^ (value >> 15)) * 0x85EBCA6B) % 2**32 >> (32 - bits)


def toxic_margin(text: str, weights: np.ndarray, bias: float) -> float:
    """Mean over the n-grams of each window of words, then over the most toxic windows."""
    data = b" " + bytes(b + 32 if 65 <= b <= 90 else (32 if 9 <= b <= 13 else b) for b in text.encode()) + b" "
    words = [m.span() for m in re.finditer(rb"[^ ]+", data)]
    if not words:
        return bias
    sums, counts = np.zeros(len(words)), np.zeros(len(words))
    for size in toxicity.SIZES:
        for at in range(len(data) - size + 1):
            if b" " in data[at + 1 : at + size - 1]:
                continue
            word = sum(begin <= at + 1 for begin, _ in words) - 1
            if word >= 0:
                sums[word] += weights[rolled(data[at : at + size], toxicity.BUCKET_BITS)]
                counts[word] += 1
    logits = [
        sums[i : i + toxicity.WINDOW].sum() / max(counts[i : i + toxicity.WINDOW].sum(), 1)
        for i in range(0, len(words), toxicity.WINDOW)]
    return bias + float(np.mean(sorted(logits)[-toxicity.TOP :]))


@pytest.mark.parametrize("size", [1 << 20, 64])
def test_toxic_margins_by_definition(monkeypatch, size):
    rng = np.random.default_rng(4)
    weights = rng.normal(size=1 << toxicity.BUCKET_BITS)
    pieces = toxicity.text_pieces
    monkeypatch.setattr(toxicity, "text_pieces", lambda texts: pieces(texts, size))
    found = toxicity.likeliest_windows(pa.array([*TEXTS, None], pa.large_string()), weights, 0.25)
    assert found == pytest.approx([toxic_margin(t, weights, 0.25) for t in [*TEXTS, ""]])


def plain_indicators(text: str) -> set[int]:
    data = text.encode()
    found = {rolled(data[i : i + n], quality_model.BYTE_BITS) for n in quality_model.BYTE_SIZES for i in range(len(data) - n + 1)}
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    lower = [bytes(b + 32 if 65 <= b <= 90 else b for b in w) for w in words]
    shapes = [
        (any(c in b"#*$%&|<>{}=\\^~_" for c in w)) + 2 * any(c in b"!?" for c in w)
        + 4 * (not any(97 <= c <= 122 or c >= 0xC3 for c in w)) + 8 * any(48 <= c <= 57 for c in w)
        + 16 * (lower[i] in lower[max(0, i - 8) : i]) for i, w in enumerate(words)]
    pairs = [a * quality_model.SHAPES + b for a, b in zip(shapes, shapes[1:], strict=False)]
    for k, level in enumerate(quality_model.LEVELS):
        found |= {(1 << quality_model.BYTE_BITS) + k * quality_model.SHAPES**2 + p
                  for p in set(pairs) if pairs.count(p) / len(pairs) > level}
    return found


def test_quality_indicators_by_definition():
    found = dict(quality_model.indicators(pa.array([*TEXTS, None], pa.large_string())))
    assert [set(found[i].tolist()) for i in range(len(TEXTS) + 1)] == [plain_indicators(t) for t in [*TEXTS, ""]]


def test_quality_fit_against_a_dense_descent():
    """The same dual steps on a dense matrix; at the end the multipliers fulfil the conditions of the optimum closely."""
    texts = [" ".join(prose(i, 12)) + (" ### !!" if i % 3 == 0 else ".") for i in range(24)]
    y = np.array([0 if i % 3 == 0 else 1 for i in range(24)])
    found = [np.array(sorted(plain_indicators(t))) for t in texts]
    ratios, weights = quality_model.fit_weights(found, y)
    dense = np.zeros((len(texts), quality_model.FEATURES))
    for row, indices in zip(dense, found, strict=True):
        row[indices] = 1
    counts = [1 + dense[y == c].sum(0) for c in (0, 1)]
    expected = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    assert ratios == pytest.approx(expected)
    x = dense * expected
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    sign, kernel = np.where(y == 1, 1.0, -1.0), x @ x.T
    bound = len(y) / (2 * np.where(y == 1, (y == 1).sum(), (y == 0).sum()))
    alpha, rng = np.zeros(len(y)), np.random.default_rng(quality_model._SEED)
    for _ in range(quality_model.EPOCHS):
        for i in rng.permutation(len(y)):
            gradient = sign[i] * (kernel[i] @ (alpha * sign)) - 1
            alpha[i] = np.clip(alpha[i] - gradient, 0, bound[i])
    assert weights == pytest.approx(x.T @ (alpha * sign))
    gradient = sign * (x @ weights) - 1
    assert np.all((np.abs(gradient) < 0.05) | ((alpha == 0) & (gradient > 0)) | ((alpha == bound) & (gradient < 0)))
    scores = quality_model.margins(pa.array([*texts, "", None], pa.large_string()), ratios, weights)
    assert scores[:-2] == pytest.approx(x @ weights) and scores[-2:].tolist() == [0, 0]
    assert np.all((scores[:-2] > 0) == (y == 1))
