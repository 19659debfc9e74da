"""Shards by fixed virtual slots.

Records are hashed into ``SLOTS`` slots, whatever the number of shards. Bytes are summed per slot, and a slot map, one
row per slot, names the shard of each. The map is kept as versions in a table: balancing or adding a shard writes a new
version that moves as few slots as needed, and a record moves only if its slot does.

The law that holds is ``bytes``: the shards' sizes are near equal (the largest and the smallest differ by about one
slot). Only the slot table, of ``SLOTS`` rows whatever the data, is handled on the driver.

Defined results: a null text has size 8 and the checksum of an empty one; rows equal in id and text are told apart by
their number among equals, so they spread over the slots too; an empty table gives no rows; columns of the input other
than id and text are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankflow.llm.ranges import running_totals
from bankflow.plans.workspace import materialize, new_path

SLOTS = 4096
RECORD_BYTES = 8
LAW = "bytes"


def balanced(loads: Sequence[int], shards: int) -> list[int]:
    """First map: slots from heavy to light, each to the lightest shard so far."""
    heap = [(0, shard) for shard in range(shards)]
    owner = [0] * len(loads)
    for slot in sorted(range(len(loads)), key=lambda s: (-loads[s], s)):
        load, shard = heapq.heappop(heap)
        owner[slot] = shard
        heapq.heappush(heap, (load + loads[slot], shard))
    return owner


def edited(loads: Sequence[int], owner: Sequence[int], shards: int, tolerance: float = 0.02) -> list[int]:
    """Next version of a map: slots leave the fullest shard for the emptiest while it is over the mean by
    ``tolerance``. A new shard (``shards`` above what the map knows) starts empty and so takes slots from all."""
    owner = list(owner)
    totals = [0] * shards
    for slot, shard in enumerate(owner):
        totals[shard] += loads[slot]
    mean = sum(totals) / shards
    held: dict[int, list[int]] = {}
    for slot in sorted(range(len(owner)), key=lambda s: (loads[s], s)):
        held.setdefault(owner[slot], []).append(slot)
    while True:
        full, empty = max(range(shards), key=totals.__getitem__), min(range(shards), key=totals.__getitem__)
        gap = totals[full] - totals[empty]
        if totals[full] <= mean * (1 + tolerance) and totals[empty] >= mean * (1 - tolerance):
            return owner
        # The largest slot that brings neither shard across the mean; else the smallest that narrows the gap.
        room = min(totals[full] - mean, mean - totals[empty])
        own = held.get(full, [])
        slot = next((s for s in reversed(own) if 0 < loads[s] <= room), None)
        if slot is None:
            slot = next((s for s in own if 0 < loads[s] < gap), None)
        if slot is None:
            return owner
        held[full].remove(slot)
        held.setdefault(empty, []).append(slot)
        held[empty].sort(key=lambda s: (loads[s], s))
        owner[slot] = empty
        totals[full] -= loads[slot]
        totals[empty] += loads[slot]


class SlotMap:
    """Versions of the slot map under one folder; a version is never changed once written."""

    _SCHEMA = "version int, slot int, shard int"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def write(self, version: int, owner: Sequence[int]) -> DataFrame:
        rows = [(version, slot, shard) for slot, shard in enumerate(owner)]
        self.spark.createDataFrame(rows, self._SCHEMA).coalesce(1).write.parquet(f"{self.path}/v{version}")
        return self.read(version)

    def read(self, version: int) -> DataFrame:
        """``SLOTS`` rows: the bound that lets joins broadcast it."""
        return self.spark.read.schema(self._SCHEMA).parquet(f"{self.path}/v{version}")

    def latest(self) -> int:
        """Number of the newest version."""
        return self.spark.read.schema(self._SCHEMA).parquet(f"{self.path}/v*").agg(F.max("version")).first()[0]

    def owner(self, version: int) -> list[int]:
        return [r["shard"] for r in self.read(version).orderBy("slot").collect()]


def slot_loads(records: DataFrame) -> list[int]:
    """Bytes per slot: at most ``SLOTS`` rows reach the driver."""
    loads = [0] * SLOTS
    for row in records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes")).collect():
        loads[row["virtual_slot"]] = row["bytes"]
    return loads


def records_of(docs: DataFrame) -> DataFrame:
    """Narrow table of the documents: id, size, checksum, row and virtual slot. Written, so row numbers stand."""
    text = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    rows = materialize(docs.select(
        "doc_id",
        (F.octet_length(F.coalesce(F.col("text"), F.lit(""))) + RECORD_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    ).withColumn("row", F.monotonically_increasing_id())
        .withColumn("record", F.xxhash64("doc_id", "text_crc32", "size")), "records")
    repeated = rows.groupBy("record").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("record")
    # Equal records get numbers, so that a third of all rows being equal does not fill one slot.
    numbered = running_totals(
        rows.join(repeated, "record", "left_semi").withColumn("one", F.lit(1)), "one", ["row"], ["record"], "copy"
    ).drop("one")
    single = rows.join(repeated, "record", "left_anti").withColumn("copy", F.lit(0).cast("long"))
    return materialize(
        single.unionByName(numbered)
        .withColumn("virtual_slot", F.pmod(F.xxhash64("record", "copy"), F.lit(SLOTS)).cast("int"))
        .drop("record", "copy"), "slotted",
    )


def shard(docs: DataFrame, shards: int = 24, path: str | None = None) -> DataFrame:
    """Places all documents and returns ``doc_id, size, text_crc32, row, virtual_slot, shard``.

    The map is written as version 1 under ``path`` (a new folder in the shared one by default).
    """
    records = records_of(docs)
    slot_map = SlotMap(docs.sparkSession, path or new_path(docs.sparkSession, "slot_map"))
    version = slot_map.write(1, balanced(slot_loads(records), shards)).select(
        F.col("slot").alias("virtual_slot"), "shard")
    return records.join(F.broadcast(version), "virtual_slot")


def rebalance(records: DataFrame, path: str, shards: int, tolerance: float = 0.02) -> DataFrame:
    """Edits the newest map under ``path`` for the present bytes of its slots and ``shards`` shards, writes it as the next
    version and returns the records with ``shard`` and the ``old_shard`` before. A record moves only with its slot."""
    slot_map = SlotMap(records.sparkSession, path)
    version = slot_map.latest()
    owner = slot_map.owner(version)
    slot_map.write(version + 1, edited(slot_loads(records), owner, shards, tolerance))
    both = slot_map.read(version).select(F.col("slot").alias("virtual_slot"), F.col("shard").alias("old_shard")).join(
        slot_map.read(version + 1).select(F.col("slot").alias("virtual_slot"), "shard"), "virtual_slot")
    return records.drop("shard").join(F.broadcast(both), "virtual_slot")


def shard_digest(docs: DataFrame, shards: int = 24) -> DataFrame:
    """Per document: size, checksum, shard, and its place in the shard, numbered from 0 without gaps."""
    placed = shard(docs, shards).withColumn("one", F.lit(1))
    numbered = running_totals(placed, "one", ["virtual_slot", "doc_id", "text_crc32", "row"], ["shard"], "slot")
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )
