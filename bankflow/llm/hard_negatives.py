"""Hard negatives of anchor vectors, by a secondary-sort shuffle.

Rows are scored against the anchors in blocks: a block of rows and a block of anchors meet in a task, anchors first, and
numpy multiplies them. Scores are packed with their row into keys (anchor, descending score, id) whose bytes sort in that
order; ``repartitionAndSortWithinPartitions`` sends an anchor's keys to one task in order, and an iterator reads them once:
a positive opens a window of scores, a negative is given to the open windows that it falls in, and a window closes when
it has had its number. No anchor's rows are ever held.

An anchor has as many pairs as the table has rows, so keys are cut before the shuffle to those that can be in the result,
without loss: a block's first positives only, and, once the positives are known, its first negatives of each window. The
keys of an anchor are then at most (positives + positives * negatives) for each block.

Scores are exact: components are whole numbers after quantisation, and products that could pass 2^53 are made in 64-bit
or larger integers. A score beyond 64 bits fails the job, as a sum does.

Defined results: rows with a null id, label or vector, or any component null or not finite, take no part; a vector meets
those of its own length only; rows that repeat an id are rows of their own (each is an anchor, positive or negative for
itself); ties go by id, then in the order read; an anchor without positives, and an empty table, give no rows; other
columns are not read.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankflow.plans.workspace import materialize

SCALE = 256
# Components of a block of rows, and anchors of a block.
BLOCK_VALUES = 1 << 17
BLOCK_ANCHORS = 512
# Keys that one task of the sort takes, about.
TASK_KEYS = 1 << 16

_KEY = np.dtype([("anchor", ">u8"), ("anchor_row", ">u8"), ("score", ">u8"), ("kind", "u1"), ("id", ">u8"), ("row", ">u8")])
_PACKED = ">QQQBQQ"
_SIGN = 1 << 63
POSITIVE, NEGATIVE = 0, 1


def packed(anchor, anchor_row, score, kind, id_, row) -> np.ndarray:
    """Keys whose bytes sort by anchor, then descending score, then positives first, then id and row."""
    def ascending(x) -> np.ndarray:
        return np.asarray(x, np.int64).view(np.uint64) ^ np.uint64(_SIGN)

    out = np.empty(len(id_), _KEY)
    out["anchor"], out["anchor_row"] = ascending(anchor), ascending(anchor_row)
    out["score"], out["kind"] = ~ascending(score), kind
    out["id"], out["row"] = ascending(id_), ascending(row)
    return out


def unpacked(key: bytes) -> tuple[int, int, int, int, int, int]:
    anchor, anchor_row, score, kind, id_, row = struct.unpack(_PACKED, key)
    return anchor - _SIGN, anchor_row - _SIGN, _SIGN - 1 - score, kind, id_ - _SIGN, row - _SIGN


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``a`` and ``b`` (whole numbers as doubles), exact, as 64-bit integers."""
    most = (np.abs(a).max(initial=0) * np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2.0**53:
        return (a @ b.T).astype(np.int64)
    if most < 2.0**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    whole = np.frompyfunc(int, 1, 1)
    exact = whole(a) @ whole(b).T
    if exact.size and not (-_SIGN <= exact.min() and exact.max() < _SIGN):
        raise OverflowError("an inner product does not fit 64 bits")
    return exact.astype(np.int64)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of one pair of blocks; rows come sorted by ``dim, anchor_block, row_block, side``."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in ("dim", "anchor_block", "row_block")], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(batch)]
        for first, last in zip(cuts, cuts[1:], strict=False):
            if first == last:
                continue
            found = tuple(keys[first])
            if found != key and held:
                yield pa.Table.from_batches(held)
                held = []
            key = found
            held.append(batch.slice(first, last - first))
    if held:
        yield pa.Table.from_batches(held)


def _matrix(table: pa.Table, dim: int) -> np.ndarray:
    flat = table.column("vector").combine_chunks().flatten()
    return np.floor(flat.to_numpy(zero_copy_only=False).astype(np.float64) * SCALE).reshape(len(table), dim)


def _keys(parts: list[np.ndarray]) -> pa.RecordBatch:
    # Joining arrays gives them the machine's byte order; keys sort by theirs.
    keys = np.concatenate(parts).astype(_KEY)
    fixed = pa.Array.from_buffers(pa.binary(_KEY.itemsize), len(keys), [None, pa.py_buffer(keys.tobytes())])
    return pa.RecordBatch.from_arrays([fixed.cast(pa.binary())], ["key"])


def _scored(choose: Callable) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Keys of each pair of blocks; ``choose`` gives the rows to keep for one anchor and their kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            side = table.column("side").to_numpy()
            anchors, rows = table.filter(pa.array(side == 0)), table.filter(pa.array(side == 1))
            if not len(anchors) or not len(rows):
                continue
            dim = table.column("dim")[0].as_py()
            # Rows in the order of ties, so that a stable sort by score settles them.
            rows = rows.sort_by([("vec_id", "ascending"), ("row", "ascending")])
            ids, places, labels = (rows.column(c).to_numpy() for c in ("vec_id", "row", "label"))
            b, parts = _matrix(rows, dim), []
            for at in range(0, len(anchors), 64):
                some = anchors.slice(at, 64)
                scores = products(_matrix(some, dim), b)
                for k, anchor in enumerate(some.select(["vec_id", "row", "label", "windows"]).to_pylist()):
                    order = np.argsort(-scores[k], kind="stable")
                    order = order[places[order] != anchor["row"]]
                    kept, kind = choose(scores[k][order], labels[order] == anchor["label"], anchor["windows"])
                    kept = order[kept]
                    parts.append(packed(
                        np.full(len(kept), anchor["vec_id"]), np.full(len(kept), anchor["row"]), scores[k][kept], kind,
                        ids[kept], places[kept]))
            if parts:
                yield _keys(parts)

    return run


def _first_positives(count: int):
    def choose(scores: np.ndarray, same: np.ndarray, windows) -> tuple[np.ndarray, int]:
        return np.flatnonzero(same)[:count], POSITIVE

    return choose


def _first_negatives(count: int, low: int, high: int):
    def choose(scores: np.ndarray, same: np.ndarray, windows: list[int]) -> tuple[np.ndarray, int]:
        others = np.flatnonzero(~same)
        held = scores[others].tolist()
        kept: set[int] = set()
        for positive in windows:
            # Scores descend; whole numbers of any size are compared.
            first = _first_at_most(held, high * positive)
            for at in range(first, min(first + count, len(held))):
                if 100 * held[at] < low * positive:
                    break
                kept.add(at)
        return others[sorted(kept)], NEGATIVE

    return choose


def _first_at_most(descending: list[int], limit: int) -> int:
    low, high = 0, len(descending)
    while low < high:
        middle = (low + high) // 2
        if 100 * descending[middle] <= limit:
            high = middle
        else:
            low = middle + 1
    return low


def _in_blocks(rows: DataFrame, anchors: DataFrame, row_blocks: int, anchor_blocks: int) -> DataFrame:
    """Every block of rows beside every block of anchors, anchors first."""
    def block(column: str, blocks: int, seed: int) -> Column:
        return F.pmod(F.xxhash64(F.col(column), F.lit(seed)), F.lit(blocks)).cast("int")

    def every(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    columns = ["dim", "vec_id", "row", "label", "vector"]
    left = anchors.select(*columns, "windows", F.lit(0).alias("side"), block("row", anchor_blocks, 1).alias("anchor_block"),
                          every(row_blocks).alias("row_block"))
    right = rows.select(*columns, F.lit(None).cast("array<long>").alias("windows"), F.lit(1).alias("side"),
                        block("row", row_blocks, 2).alias("row_block"), every(anchor_blocks).alias("anchor_block"))
    key = ["dim", "anchor_block", "row_block"]
    return left.unionByName(right).repartition(row_blocks * anchor_blocks, *key).sortWithinPartitions(*key, "side")


def _sorted_keys(keys: DataFrame) -> RDD:
    """The keys, an anchor's in one partition and in order."""
    partitions = max(keys.sparkSession.sparkContext.defaultParallelism, math.ceil(keys.count() / TASK_KEYS))
    return keys.rdd.map(lambda r: (bytes(r[0]), None)).repartitionAndSortWithinPartitions(
        partitions, lambda key: zlib.crc32(key[:16]))


def _opening(count: int):
    """The first positives of every anchor, from sorted keys."""
    def run(pairs: Iterator[tuple[bytes, None]]) -> Iterator[tuple]:
        current, taken = None, 0
        for key, _ in pairs:
            if key[:16] != current:
                current, taken = key[:16], 0
            if taken < count:
                taken += 1
                anchor, anchor_row, score, _, id_, row = unpacked(key)
                yield anchor, anchor_row, id_, row, score

    return run


def _emitting(count: int, low: int, high: int):
    """Negatives of the windows that positives open, from sorted keys."""
    def run(pairs: Iterator[tuple[bytes, None]]) -> Iterator[tuple]:
        current, windows = None, []
        for key, _ in pairs:
            if key[:16] != current:
                current, windows = key[:16], []
            anchor, _, score, kind, id_, _ = unpacked(key)
            if kind == POSITIVE:
                windows.append([id_, score, 0])
                continue
            for window in windows:
                positive, reached, given = window
                if given < count and low * reached <= 100 * score <= high * reached:
                    window[2] += 1
                    yield anchor, positive, given + 1, id_, reached, score

    return run


_POSITIVES = "anchor_id long, row long, positive_id long, positive_row long, positive_score long"
_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(
    vectors: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90
) -> DataFrame:
    """For each anchor and each of its first ``positives`` rows of the same label: the first ``negatives`` rows of other
    labels that score from ``low`` to ``high`` percent of the positive.

    ``vectors`` has ``vec_id, label, embedding`` and ``is_anchor``.
    """
    spark = vectors.sparkSession
    component = F.transform("embedding", lambda x: x.cast("double"))
    rows = materialize(
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                       component.alias("vector"), "is_anchor")
        .filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & F.forall(
            "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))))
        .withColumn("dim", F.size("vector")).withColumn("row", F.monotonically_increasing_id()), "vectors")
    values, most = rows.agg(F.sum("dim"), F.count_if("is_anchor")).first()
    if not most:
        return spark.createDataFrame([], _RESULT)
    row_blocks, anchor_blocks = math.ceil(max(values, 1) / BLOCK_VALUES), math.ceil(most / BLOCK_ANCHORS)
    anchors = rows.filter("is_anchor")

    near = materialize(
        _in_blocks(rows, anchors.withColumn("windows", F.array().cast("array<long>")), row_blocks, anchor_blocks)
        .mapInArrow(_scored(_first_positives(positives)), "key binary"), "positive_keys")
    found = materialize(
        spark.createDataFrame(_sorted_keys(near).mapPartitions(_opening(positives)), _POSITIVES, verifySchema=False),
        "positives")
    windows = found.groupBy("row").agg(F.collect_set("positive_score").alias("windows"))
    far = materialize(
        _in_blocks(rows, anchors.join(windows, "row"), row_blocks, anchor_blocks)
        .mapInArrow(_scored(_first_negatives(negatives, low, high)), "key binary"), "negative_keys")
    # Only the positives that were found open windows, so their keys are made anew.
    opening = found.mapInArrow(_positive_keys, "key binary")
    result = _sorted_keys(opening.unionByName(far)).mapPartitions(_emitting(negatives, low, high))
    return spark.createDataFrame(result, _RESULT, verifySchema=False)


def _positive_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if len(batch):
            columns = {c: batch.column(c).to_numpy() for c in batch.schema.names}
            yield _keys([packed(
                columns["anchor_id"], columns["row"], columns["positive_score"], POSITIVE, columns["positive_id"],
                columns["positive_row"])])


def hard_negatives_digest(embeddings: DataFrame) -> DataFrame:
    """Anchors are the rows whose id 100 divides; where 7 divides it, the label is the next of ten."""
    label = F.col("label").cast("long")
    return hard_negatives(embeddings.select(
        "vec_id", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), "embedding",
        F.coalesce(F.col("vec_id") % 100 == 0, F.lit(False)).alias("is_anchor")))
