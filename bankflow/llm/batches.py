"""Texts of Arrow batches as byte arrays for numpy, in pieces of bounded size, and hashes of their words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text worked on at once; a longer single text is a piece of its own.
PIECE_BYTES = 1 << 20

_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def text_pieces(texts: pa.Array, piece_bytes: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first, last, data, bounds)``: rows first to last (exclusive), their UTF-8 bytes, and where each row begins in
    them (one more bound than rows). Null texts are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    if n == 0:
        return
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(bounds, bounds[first] + piece_bytes, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last, data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
        first = last


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64, and of its inverse."""
    inverse = pow(_ODD, -1, 1 << 64)
    up, down = np.ones(count, np.uint64), np.ones(count, np.uint64)
    up[1:], down[1:] = np.uint64(_ODD), np.uint64(inverse)
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def word_bounds(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word (runs of bytes other than space and 09 to 0D), and the words before each row."""
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~blank
    change = np.diff(inside)
    starts, ends = change > 0, change < 0
    # A row that begins inside a run of bytes cuts it.
    cuts = bounds[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    cuts = cuts[~blank[cuts] & ~blank[cuts - 1]]
    starts[cuts] = True
    ends[cuts] = True
    begin, end = np.flatnonzero(starts), np.flatnonzero(ends)
    return begin, end, np.searchsorted(begin, bounds)


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of every word, A to Z in lower case."""
    if not len(begin):
        return np.zeros(0, np.uint64)
    lower = data + ((data >= 65) & (data <= 90)) * np.uint8(32)
    up, down = powers(len(data) + 1)
    summed = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((lower.astype(np.uint64) + np.uint64(1)) * up[:-1], out=summed[1:])
    return mix64((summed[end] - summed[begin]) * down[begin] + (end - begin).astype(np.uint64))


def shingle_sets(texts: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted distinct hashes of its shingles of ``words`` words; a row with fewer words has one for all of them,
    a row without words none."""
    for first, last, data, bounds in text_pieces(texts):
        begin, end, before = word_bounds(data, bounds)
        hashes = word_hashes(data, begin, end)
        joined = hashes.copy()
        for k in range(1, words):
            joined[:-k] = mix64(joined[:-k] * np.uint64(_ODD) + hashes[k:]) if k < len(joined) else joined[:-k]
        for row in range(last - first):
            start, stop = before[row], before[row + 1]
            if stop - start >= words:
                yield first + row, np.unique(joined[start : stop - words + 1])
            elif stop > start:
                whole = np.uint64(stop - start)
                for h in hashes[start:stop]:
                    whole = mix64(np.array([whole], np.uint64) * np.uint64(_ODD) + h)[0]
                yield first + row, np.array([whole], np.uint64)
            else:
                yield first + row, np.zeros(0, np.uint64)
