"""Byte-level BPE encoding and decoding by the ranks of a public vocabulary file.

Texts are cut by the vocabulary's pattern, and each piece is encoded on its own. Pieces that are new to a task are encoded
together: pieces of a length class are rows of a padded matrix, every row merges its leftmost pair of minimum rank in each
round, pairs are looked up in a hash table, rows close up over the merged place, and rows with no pair left leave the
matrix. Encoded pieces are kept in a table of bounded size for the texts that follow in the task.

Defined results: a null text counts as empty and has no tokens; special tokens are ordinary text; texts are read whole;
pieces above ``LONG_PIECE`` bytes are merged with a heap, with the same result; every row gets one result, repeated rows
too; an empty table gives an empty table; the columns of the input are kept, and columns named like the output are
replaced. One pass over the scan: no shuffle.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LONG_PIECE = 512
# Encoded pieces kept in a task.
KEPT_PIECES = 150_000
# Texts that are encoded together.
TEXTS_AT_ONCE = 256

_NONE = np.int32(2**31 - 1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank, from a file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = [b""] * (1 + max(int(rank) for _, rank in pairs))
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class PairTable:
    """Open addressing from a pair of token ids to the id of both joined."""

    def __init__(self, tokens: list[bytes]):
        ids = {token: i for i, token in enumerate(tokens) if token}
        keys, values = [], []
        for token, i in ids.items():
            for cut in range(1, len(token)):
                left, right = ids.get(token[:cut]), ids.get(token[cut:])
                if left is not None and right is not None:
                    keys.append((left << 32) | right)
                    values.append(i)
        keys, values = np.array(keys, np.uint64), np.array(values, np.int32)
        bits = max(int(np.ceil(np.log2(4 * max(len(keys), 1)))), 4)
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys, self.values = np.full(1 << bits, 2**64 - 1, np.uint64), np.full(1 << bits, _NONE, np.int32)
        slots, left, self.probes = self._slot(keys), np.arange(len(keys)), 0
        while len(left):
            self.probes += 1
            free = self.values[slots[left]] == _NONE
            at, first = np.unique(slots[left][free], return_index=True)
            placed = left[free][first]
            self.keys[at], self.values[at] = keys[placed], values[placed]
            left = np.setdiff1d(left, placed, assume_unique=True)
            slots[left] = (slots[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _MIX) >> self.shift).astype(np.int64)

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of the joined pairs, ``_NONE`` where there is none. Ids are ranks."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        slots = self._slot(keys)
        found = np.where(self.keys[slots] == keys, self.values[slots], _NONE)
        open_ = np.flatnonzero((found == _NONE) & (self.values[slots] != _NONE))
        for _ in range(self.probes):
            if not len(open_):
                break
            slots[open_] = (slots[open_] + 1) & self.mask
            at = slots[open_]
            hit = self.keys[at] == keys[open_]
            found[open_[hit]] = self.values[at[hit]]
            open_ = open_[~hit & (self.values[at] != _NONE)]
        return found


class Codec:
    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens = tokens
        self.whole = {token: i for i, token in enumerate(tokens) if token}
        self.byte_ids = np.array([self.whole[bytes([b])] for b in range(256)], np.int32)
        self.table = PairTable(tokens)
        self.find = regex.compile(pattern).findall
        self.kept: dict[str, list[int]] = {}

    def _merge(self, rows: np.ndarray) -> list[list[int]]:
        """Token ids of pieces given as rows of byte ids, padded with -1."""
        out: list[list[int]] = [[]] * len(rows)
        index = np.arange(len(rows))
        width = rows.shape[1]
        ranks = np.full((len(rows), width), _NONE, np.int32)
        if width > 1:
            inner = rows[:, 1:] >= 0
            ranks[:, :-1][inner] = self.table.joined(rows[:, :-1][inner], rows[:, 1:][inner])
        while len(index):
            at = ranks.argmin(axis=1)
            every = np.arange(len(index))
            best = ranks[every, at]
            done = best == _NONE
            if done.any():
                for i, row in zip(index[done], rows[done].tolist(), strict=True):
                    out[i] = row[: row.index(-1)] if row[-1] < 0 else row
                going = ~done
                index, rows, ranks, at, best = index[going], rows[going], ranks[going], at[going], best[going]
                every = np.arange(len(index))
                if not len(index):
                    break
            # Close up over the right half of the merged pair.
            source = np.arange(rows.shape[1] - 1)[None, :]
            source = source + (source > at[:, None])
            rows, ranks = np.take_along_axis(rows, source, 1), np.take_along_axis(ranks, source, 1)
            rows[every, at] = best
            last = rows.shape[1] - 1
            # The pairs on both sides of the new token.
            right = rows[every, np.minimum(at + 1, last)]
            has_right = (at < last) & (right >= 0)
            ranks[every, at] = _NONE
            ranks[every[has_right], at[has_right]] = self.table.joined(best[has_right], right[has_right])
            has_left = at > 0
            ranks[every[has_left], at[has_left] - 1] = self.table.joined(
                rows[every[has_left], at[has_left] - 1], best[has_left])
        return out

    def _merge_long(self, piece: bytes) -> list[int]:
        """One long piece, by a heap of pairs over a linked list."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        tokens, whole = self.tokens, self.whole

        def pair(i: int) -> tuple[int, int, int, int] | None:
            if after[i] >= n:
                return None
            joined = whole.get(tokens[ids[i]] + tokens[ids[after[i]]])
            return None if joined is None else (joined, i, ids[i], ids[after[i]])

        heap = [p for i in range(n) if (p := pair(i))]
        heapq.heapify(heap)
        while heap:
            joined, i, left, right = heapq.heappop(heap)
            if ids[i] != left or after[i] >= n or ids[after[i]] != right:
                continue
            gone = after[i]
            ids[i], ids[gone] = joined, -1
            after[i] = after[gone]
            if after[i] < n:
                before[after[i]] = i
            for j in (i, before[i]):
                if j >= 0 and (p := pair(j)):
                    heapq.heappush(heap, p)
        return [i for i in ids if i >= 0]

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(pieces)
        classes: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            token = self.whole.get(piece)
            if token is not None:
                out[i] = [token]
            elif len(piece) > LONG_PIECE:
                out[i] = self._merge_long(piece)
            else:
                classes.setdefault(len(piece) if len(piece) <= 16 else 1 << (len(piece) - 1).bit_length(), []).append(i)
        for width, members in classes.items():
            lengths = np.array([len(pieces[i]) for i in members])
            filled = np.arange(width)[None, :] < lengths[:, None]
            rows = np.full((len(members), width), -1, np.int32)
            rows[filled] = self.byte_ids[np.frombuffer(b"".join(pieces[i] for i in members), np.uint8)]
            for i, ids in zip(members, self._merge(rows), strict=True):
                out[i] = ids
        return out

    def encode(self, texts: list[str]) -> list[list[int]]:
        cut = [self.find(text) for text in texts]
        if len(self.kept) > KEPT_PIECES:
            self.kept.clear()
        new = list(set(chain.from_iterable(cut)).difference(self.kept))
        self.kept.update(zip(new, self.encode_pieces([piece.encode() for piece in new]), strict=True))
        return [list(chain.from_iterable(map(self.kept.__getitem__, pieces))) for pieces in cut]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def _default_vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def tokenize(docs: DataFrame, path: str | None = None, pattern: str | None = None, text: str = "text") -> DataFrame:
    """Adds ``ids`` (array of int) and ``decoded`` (the bytes that the ids stand for) to every row.

    ``path`` is the rank file, read once on the driver; its tokens travel to the tasks.
    """
    if path is None or pattern is None:
        known = _default_vocabulary()
        path, pattern = path or known[0], pattern or known[1]
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_ranks(path))
    kept = [f for f in docs.schema.fields if f.name not in ("ids", "decoded")]
    names = [f.name for f in kept]
    # A copy of the text under a name of its own, so that columns of any name and case can be there.
    source = docs.select(*(F.col(f"`{n}`") for n in names), F.coalesce(F.col(text), F.lit("")).alias("_bpe_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(vocabulary.value, pattern)
        for batch in batches:
            for at in range(0, len(batch), TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                encoded = codec.encode(part.column(len(names)).to_pylist())
                bounds = np.zeros(len(encoded) + 1, np.int32)
                np.cumsum([len(ids) for ids in encoded], out=bounds[1:])
                flat = np.fromiter(chain.from_iterable(encoded), np.int32, int(bounds[-1]))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: len(names)], pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat)),
                     pa.array([codec.decode(ids) for ids in encoded], pa.binary())],
                    [*names, "ids", "decoded"],
                )

    schema = T.StructType([*kept, T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("decoded", T.BinaryType())])
    return source.mapInArrow(run, schema)


def token_digest(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per document: number of tokens, a hash of the ids and a hash of the decoded bytes."""
    coded = tokenize(docs.select(*keep, "text").withColumnRenamed("text", "_text"), text="_text")
    return coded.select(
        *keep, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
