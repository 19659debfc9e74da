"""Near-duplicate documents by SetSketch registers.

A document is the set of its word shingles. A sketch has ``REGISTERS`` values; each is the exponentially spaced,
truncated minimum of exponential variates of the shingles, so the sketch of a union is the registerwise maximum. Two
documents share a register value with a probability near their Jaccard similarity: documents whose registers agree in a
whole band share a bucket and are candidates. A crowd of texts that are alike, but no links, shares buckets everywhere,
so candidates are paired by the rarest shingles of their full sets (see ``linking``), which no two links miss. Pairs are
estimated jointly by maximum likelihood from the counts of larger, equal and smaller registers, and those that pass, with
a margin of more than five standard deviations, are verified on their full sets.

Documents with equal sets are one class before anything is paired, so copies cost a row in an aggregation. Classes are
linked through centres, the one with the fewest shingles of its own first, so a bucket of any size makes no square of
pairs.

A text with one link at the threshold shares no band with a probability of (1 - 0.8^5)^32, 3 in a million; more alike, or
with more links, less.

Defined results: a null text is empty; a document without words has an empty set and is linked with nothing; rows equal
in id and text get the same result; a null id takes no part in links and its row is kept, alone; texts are read whole; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankflow.llm.batches import mix64, shingle_sets
from bankflow.llm.linking import link_groups, may_link, rare_keys, shared_buckets
from bankflow.plans.workspace import materialize

REGISTERS = 160
BANDS = 32
BASE = 1.001
RATE = 20.0
TOP = (1 << 16) - 1

MARGIN = 0.2
_BLOCK = 1024


def _multipliers() -> np.ndarray:
    seeds = mix64(np.arange(1, REGISTERS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (seeds >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def sketch(shingles: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """Registers of a set: the least variate of each register, on a scale of powers of ``BASE``."""
    low = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    least = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), _BLOCK):
        np.minimum(least, (low[at : at + _BLOCK, None] * multipliers[None, :]).min(axis=0), out=least)
    return registers_of(least)


def registers_of(least: np.ndarray) -> np.ndarray:
    uniform = (least.astype(np.float64) + 0.5) / 2.0**32
    variate = -np.log1p(-uniform) / RATE
    # The middle of the scale stands for 1, so that sets from one to very many shingles fit.
    level = np.floor(1 - np.log(variate) / np.log(BASE)) + TOP // 4
    return np.clip(level, 0, TOP).astype(np.uint16)


def estimate(u: np.ndarray, v: np.ndarray, n_u: np.ndarray, n_v: np.ndarray) -> np.ndarray:
    """Likeliest Jaccard similarity of pairs of sketches (rows of registers) of sets of known sizes."""
    larger, smaller = (u > v).sum(1), (u < v).sum(1)
    equal = u.shape[1] - larger - smaller
    share_u, share_v = n_u / (n_u + n_v), n_v / (n_u + n_v)

    def exceeds(x):
        return -np.log1p(-np.clip(x, 1e-12, 1.0) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j):
        p, q = exceeds(share_u - share_v * j), exceeds(share_v - share_u * j)
        return larger * np.log(p) + smaller * np.log(q) + equal * np.log(np.clip(1 - p - q, 1e-12, 1.0))

    low, high = np.zeros(len(u)), np.minimum(share_u / share_v, share_v / share_u)
    for _ in range(40):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        rising = likelihood(a) < likelihood(b)
        low, high = np.where(rising, a, low), np.where(rising, high, b)
    return (low + high) / 2


def _digest(shingles: np.ndarray) -> tuple[int, int]:
    high, low = np.frombuffer(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest(), np.int64)
    return int(high), int(low)


def _sketched(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        multipliers = _multipliers()
        for batch in batches:
            sizes, high, low, registers = [], [], [], []
            for _, shingles in shingle_sets(batch.column("text"), words):
                h, l = _digest(shingles)
                sizes.append(len(shingles))
                high.append(h)
                low.append(l)
                registers.append(sketch(shingles, multipliers).tobytes() if len(shingles) else b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int64()),
                 pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array(registers, pa.binary())],
                ["doc_id", "text_hash", "n_shingles", "high", "low", "registers"],
            )

    return run


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = REGISTERS // BANDS
    for batch in batches:
        n = len(batch)
        if not n:
            continue
        values = np.frombuffer(b"".join(batch.column("registers").to_pylist()), np.uint16).reshape(n, BANDS, rows)
        keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (n, BANDS)).copy()
        for k in range(rows):
            keys = mix64(keys * np.uint64(0x9E3779B97F4A7C15) + values[:, :, k])
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.view(np.int64).ravel()), pa.array(np.repeat(batch.column("id").to_numpy(), BANDS))],
            ["key", "id"],
        )


def _likely(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            u, v = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(n, REGISTERS)
                for c in ("registers_a", "registers_b")
            )
            likely = estimate(u, v, *(batch.column(c).to_numpy().astype(float) for c in ("n_a", "n_b")))
            yield batch.select(["a", "b"]).filter(pa.array(likely >= least))

    return run


def _whole_sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, wanted = batch.column("id").to_pylist(), (batch.column("high"), batch.column("low"))
            wanted = list(zip(*(c.to_pylist() for c in wanted), strict=True))
            for row, shingles in shingle_sets(batch.column("text"), words):
                # Another text with the same id is not the one that was sketched.
                if _digest(shingles) == wanted[row]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([ids[row]], pa.int64()), pa.array([shingles.view(np.int64)], pa.list_(pa.int64()))],
                        ["id", "shingles"],
                    )

    return run


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (``doc_id, text``).

    Two documents are linked if 100 * intersection >= ``percent`` * union of their sets of ``words``-word shingles.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    members = materialize(rows.mapInArrow(
        _sketched(words), "doc_id long, text_hash long, n_shingles long, high long, low long, registers binary"),
        "sketches")
    linkable = members.filter("n_shingles > 0 and doc_id is not null")
    classes = materialize(
        linkable.groupBy("high", "low", "n_shingles", "registers").agg(F.min(F.struct("doc_id", "text_hash")).alias("at"))
        .select("high", "low", "n_shingles", "registers", "at.*").withColumn("id", F.monotonically_increasing_id()),
        "classes",
    )
    banded = materialize(classes.select("id", "registers").mapInArrow(_banded, "key long, id long"), "bands")
    candidates = shared_buckets(banded).select("id").distinct()
    wanted = classes.join(candidates, "id", "left_semi").select("id", "doc_id", "text_hash", "high", "low")
    sets = materialize(
        rows.join(wanted, ["doc_id", "text_hash"]).select("id", "high", "low", "text")
        .mapInArrow(_whole_sets(words), "id long, shingles array<long>").dropDuplicates(["id"]), "sets",
    )
    buckets = materialize(rare_keys(sets, percent), "rare_buckets")
    sized = classes.select("id", "n_shingles", "registers")

    def side(df: DataFrame, name: str, **columns: str) -> DataFrame:
        return df.select(F.col("id").alias(name), *(F.col(c).alias(as_) for c, as_ in columns.items()))

    def verify(pairs: DataFrame) -> DataFrame:
        both = (
            pairs.join(side(sized, "a", n_shingles="n_a", registers="registers_a"), "a")
            .join(side(sized, "b", n_shingles="n_b", registers="registers_b"), "b")
        )
        likely = both.mapInArrow(_likely(percent / 100 - MARGIN), "a long, b long")
        held = likely.join(side(sets, "a", shingles="set_a"), "a").join(side(sets, "b", shingles="set_b"), "b")
        common = F.size(F.array_intersect("set_a", "set_b"))
        return held.withColumn("common", common).filter(
            F.col("common") * 100 >= (F.size("set_a") + F.size("set_b") - F.col("common")) * percent
        ).select("a", "b")

    roots = link_groups(buckets, verify, may_link(percent), "alone")
    grouped = classes.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn(
        "root", F.coalesce("root", "id"))
    first = grouped.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = grouped.join(first, "root").select("high", "low", F.col("n_shingles").alias("_n"), "component_id")
    matched = linkable.drop("registers", "text_hash").join(named, ["high", "low"]).filter("n_shingles = _n").drop("_n")
    alone = members.filter("n_shingles = 0 or doc_id is null").drop("registers", "text_hash").withColumn(
        "component_id", F.col("doc_id"))
    return matched.unionByName(alone).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def near_dup_digest(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs, words=2, percent=80)
