"""Merkle manifest of a dataset, by time-forward processing.

Every row is a leaf. The leaves of a source form a tree, every three neighbours one node, up to its subroot; the subroots
form a tree in the same way, up to the root of the dataset. Nodes are labelled so that children come before parents (by
the last leaf below them, then by level), and are visited in the order of their labels: a node takes the digests that its
children have sent to its label out of a priority queue, and sends its own digest to the label of its parent. Then the
labels are visited backwards: a node takes the proof that its parent has sent (the siblings from its place to the root),
and sends each child that proof behind the child's own siblings, until every leaf holds its whole proof.

The queue is external. Between tasks it is a shuffle sorted by label: a block of ``3 ** BLOCK_LEVELS`` neighbours of one
source meets in one task, which sends one digest on to the next round, where the same is done with the blocks' digests.
Inside a block a heap delivers, and holds at most two messages for each level. So a source with nearly all rows is spread
over as many tasks as it has blocks, and the number of rounds is the logarithm of the rows to the base of a block.

Defined results: leaves of a source ascend by id, null ids first, then by digest, then in the order read; rows equal in
all columns are leaves of their own; null columns enter as ``-``; texts are hashed whole; a null source comes first; an
empty table has no rows and no root; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankflow.llm.ranges import running_totals
from bankflow.plans.workspace import materialize

ARITY = 3
BLOCK_LEVELS = 6
BLOCK = ARITY**BLOCK_LEVELS

LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

Label = tuple[int, int]


def leaf_digest(*columns: Column) -> Column:
    """Digest of a row: each column as its number of bytes, a colon and its text, or ``-`` where it is null."""
    def part(column: Column) -> Column:
        text = column.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(part, columns)), 256)


def node_digest(children: Sequence[str]) -> str:
    return sha256("".join(children).encode()).hexdigest()


def folded(leaf: Column, proof: Column) -> Column:
    """Root that a leaf and its proof lead to."""
    steps = F.when(proof == "", F.array().cast("array<string>")).otherwise(F.split(proof, "/"))
    return F.aggregate(steps, leaf, lambda digest, step: F.sha2(F.concat(
        F.substring_index(step, ".", 1), digest, F.substring_index(step, ".", -1)), 256))


def proof_digest(proof: Column) -> Column:
    """Digest of the siblings of a proof, in its order."""
    return F.sha2(F.translate(proof, "./", ""), 256)


def _label(level: int, index: int) -> Label:
    """The last leaf that a full node covers, then its level: a topological order in which few messages wait."""
    return (index + 1) * ARITY**level - 1, level


def _top(leaves: int) -> int:
    level = 0
    while ARITY**level < leaves:
        level += 1
    return level


def forward(digests: Sequence[str], top: int) -> tuple[str, list[tuple[Label, list[str]]]]:
    """Digest of the node ``top`` levels above the leaves of a block, and the visited nodes with their children's
    digests, in the order of their labels."""
    queue: list[tuple[Label, int, str]] = []
    visited: list[tuple[Label, list[str]]] = []

    def send(level: int, index: int, digest: str) -> None:
        heapq.heappush(queue, (_label(level + 1, index // ARITY), index, digest))

    def visit() -> None:
        label, children = queue[0][0], []
        while queue and queue[0][0] == label:
            children.append(heapq.heappop(queue)[2])
        visited.append((label, children))
        end, level = label
        digest = node_digest(children)
        if level < top:
            send(level, (end + 1) // ARITY**level - 1, digest)
        else:
            done.append(digest)

    done: list[str] = []
    for place, digest in enumerate(digests):
        visited.append((_label(0, place), [digest]))
        if top == 0:
            done.append(digest)
            continue
        send(0, place, digest)
        while queue and queue[0][0][0] <= place:
            visit()
    while queue:
        visit()
    return done[0], visited


def backward(visited: Sequence[tuple[Label, list[str]]], proof: str) -> list[str]:
    """Proof of every leaf of a block, from the proof of its top node. A step is ``left siblings.right siblings``."""
    (end, level), _ = visited[-1]
    queue: list[tuple[int, int, str]] = [(-end, -level, proof)]
    leaves: list[str] = []
    for (end, level), children in reversed(visited):
        sent = heapq.heappop(queue)
        assert (-sent[0], -sent[1]) == (end, level)
        if level == 0:
            leaves.append(sent[2])
            continue
        first = (end + 1) // ARITY**level * ARITY - ARITY
        above = f"/{sent[2]}" if sent[2] else ""
        for k in range(len(children)):
            end_below, level_below = _label(level - 1, first + k)
            step = f"{''.join(children[:k])}.{''.join(children[k + 1:])}{above}"
            heapq.heappush(queue, (-end_below, -level_below, step))
    return leaves[::-1]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, list[dict]]]:
    """Group, block and rows of every block; rows come sorted."""
    key, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            found = row["group"], row["block"]
            if found != key:
                if rows:
                    yield *key, rows
                key, rows = found, []
            rows.append(row)
    if rows:
        yield *key, rows


def _height(block: int, leaves: int) -> tuple[int, bool]:
    """Levels to climb, and whether the block is its group's only one, so that its top is the group's root."""
    alone = block == 0 and leaves < BLOCK
    return (_top(leaves) if alone else BLOCK_LEVELS), alone


def _flushed(rows: Iterator[dict], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _rising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def tops() -> Iterator[dict]:
        for group, block, rows in _blocks(batches):
            top, alone = _height(block, len(rows))
            digest, _ = forward([r["digest"] for r in rows], top)
            yield {"group": group, "pos": block, "digest": digest, "alone": alone}

    schema = pa.schema([("group", pa.string()), ("pos", pa.int64()), ("digest", pa.string()), ("alone", pa.bool_())])
    yield from _flushed(tops(), schema)


def _falling(carried: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    sent = [pa.field(name, pa.string()) for name in ("proof", "subroot")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def proofs() -> Iterator[dict]:
            for _, block, (message, *rows) in _blocks(batches):
                top, _ = _height(block, len(rows))
                _, visited = forward([r["digest"] for r in rows], top)
                for row, proof in zip(rows, backward(visited, message["proof"]), strict=True):
                    yield {name: row[name] for name in carried.names} | {"proof": proof, "subroot": message["subroot"]}

        yield from _flushed(proofs(), pa.schema([*carried, *sent]), 512)

    return run


def _in_label_order(nodes: DataFrame) -> DataFrame:
    return nodes.repartition("group", "block").sortWithinPartitions("group", "block", "pos")


def _rise(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Nodes of each round (``group, pos, digest``), and ``group, digest, round`` of the roots with the round that
    reached them. ``nodes`` is written."""
    rounds, tops = [nodes], []
    while True:
        blocked = rounds[-1].select("group", F.expr(f"pos div {BLOCK}").alias("block"), "pos", "digest")
        above = materialize(_in_label_order(blocked).mapInArrow(
            _rising, "group string, pos long, digest string, alone boolean"), name)
        tops.append(above.filter("alone").select("group", "digest", F.lit(len(rounds) - 1).alias("round")))
        left = above.filter("not alone").drop("alone")
        if left.isEmpty():
            break
        rounds.append(left)
    roots = tops[0]
    for top in tops[1:]:
        roots = roots.unionByName(top)
    return rounds, roots


def _fall(rounds: list[DataFrame], sent: DataFrame, carried: Sequence[str], name: str) -> DataFrame:
    """``carried, proof, subroot`` of the lowest nodes. ``sent`` has ``group, round, proof, subroot`` of the roots."""
    lower = None
    for number in reversed(range(len(rounds))):
        nodes = rounds[number]
        keep = list(carried) if number == 0 else ["group", "pos"]
        messages = sent.filter(F.col("round") == number).select(
            "group", F.lit(0).cast("long").alias("block"), "proof", "subroot")
        if lower is not None:
            messages = messages.unionByName(lower.select("group", F.col("pos").alias("block"), "proof", "subroot"))
        block = F.expr(f"pos div {BLOCK}").alias("block")
        wanted = list(dict.fromkeys(["group", "pos", "digest", *keep]))
        # A parent's message is sorted before the nodes of its block.
        meeting = nodes.select(*wanted, block).unionByName(
            messages.withColumn("pos", F.lit(-1).cast("long")), allowMissingColumns=True)
        kept = nodes.select(*keep).schema
        schema = T.StructType(kept.fields + [T.StructField(n, T.StringType()) for n in ("proof", "subroot")])
        arrow = pa.schema([(f.name, _ARROW[f.dataType.typeName()]) for f in kept.fields])
        lower = _in_label_order(meeting).mapInArrow(_falling(arrow), schema)
        if number:
            lower = materialize(lower, name)
    return lower


_ARROW = {"string": pa.string(), "long": pa.int64(), "integer": pa.int32()}


def merkle_manifest(docs: DataFrame, other: Column | None = None) -> DataFrame:
    """``doc_id, source_group, pos, leaf, proof, subroot, root`` for every row of ``docs``.

    ``proof`` holds a step for each level from the leaf to the root, as :func:`folded` takes it. ``other`` is a digest of
    the row's present state to be checked against the manifest; it comes back as ``other``.
    """
    leaves = materialize(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("s"), "source")).alias("group"),
        leaf_digest(*(F.col(c) for c in LEAF_COLUMNS)).alias("digest"),
        (F.lit(None).cast("string") if other is None else other).alias("other"),
    ).withColumn("row", F.monotonically_increasing_id()), "leaves")
    order = ["doc_id", "digest", "row"]
    placed = materialize(
        running_totals(leaves.withColumn("one", F.lit(1).cast("long")), "one", order, ["group"], "pos")
        .drop("one", "row"), "placed_leaves")
    rounds, subroots = _rise(placed, "nodes")
    # Subroots by source: a null source is the empty text here, and stands first.
    ordered = materialize(
        running_totals(subroots.withColumn("one", F.lit(1).cast("long")), "one", ["group"], into="pos").select(
            F.lit("").alias("group"), "pos", "digest", F.col("group").alias("source_group"), "round"), "subroots")
    upper, roots = _rise(ordered, "upper_nodes")
    top = roots.first()
    if top is None:
        return placed.select(
            "doc_id", F.col("group").alias("source_group"), "pos", F.col("digest").alias("leaf"), "other",
            *(F.lit(None).cast("string").alias(c) for c in ("proof", "subroot", "root")))
    whole = roots.select("group", "round", F.lit("").alias("proof"), F.lit("").alias("subroot"))
    messages = materialize(
        _fall(upper, whole, ["source_group", "round", "digest"], "upper_proofs")
        .select(F.col("source_group").alias("group"), "round", "proof", F.col("digest").alias("subroot")), "messages")
    return _fall(rounds, messages, ["doc_id", "group", "pos", "digest", "other"], "proofs").select(
        "doc_id", F.col("group").alias("source_group"), "pos", F.col("digest").alias("leaf"), "other", "proof", "subroot",
        F.lit(top["digest"]).alias("root"))


def manifest_digest(docs: DataFrame) -> DataFrame:
    """Per document its leaf, subroot, root and proof, and whether its present text, in which every second document by
    checksum of the id has lost its line feeds, still leads to the root."""
    present = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, leaf_digest(
        *(F.translate("text", "\n", "") if c == "text" else F.col(c) for c in LEAF_COLUMNS)))
    found = merkle_manifest(docs, present).withColumn("folded_root", folded(F.coalesce("other", "leaf"), F.col("proof")))
    return found.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))
