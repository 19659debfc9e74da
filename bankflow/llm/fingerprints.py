"""Document fingerprints: a Merkle tree over leaves, paragraphs and sections.

A paragraph is a line. Its leaves are its sentences, long ones cut every ``LEAF_WORDS`` words. A section is a run of
paragraphs that ends at an empty one, or at one whose hash says so, so an edit moves no section border far from it. A
node's hash is the hash of its children's hashes. The fingerprint is a string: the root's hash, and short codes of the
leaves' hashes, grouped by paragraph (``.``) and section (``/``). Inner nodes are told apart by the codes below them.

Equal texts have equal roots and different texts different ones. Equal branches are passed over in a comparison, and the
leaves of the differing ones locate the edits, in their order: what was left out, put in or moved. The likeness of two
fingerprints is the share of leaves that they have in common, whatever their order.

Defined results: a null text counts as empty; the empty text has no leaves, and two texts without leaves are alike (1);
equal rows get equal results; rows of one id are ordered by length and text; a null id comes before all others; the only
row of a table is its own next document; an empty table gives no rows; texts are read whole, other columns not at all.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bankflow.plans.workspace import new_path

LEAF_WORDS = 16
_LONG_SENTENCE = 160
_CODE_BYTES = 3
_CODE_CHARS = 4

Place = tuple[int, ...]
Node = tuple[Place, str]

_SENTENCE = re.compile(r"[^.!?]*+[.!?]++\s*+|[^.!?]++")
_WORDS = re.compile(rf"\s*+(?:\S++\s*+){{1,{LEAF_WORDS}}}|\s++")


def _hash(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def fingerprint(text: str) -> str:
    sections: list[list[str]] = [[]]
    hashes: list[list[bytes]] = [[]]
    for paragraph in text.split("\n"):
        leaves = []
        for sentence in _SENTENCE.findall(paragraph):
            for leaf in _WORDS.findall(sentence) if len(sentence) > _LONG_SENTENCE else (sentence,):
                leaves.append(_hash(leaf.encode()))
        node = _hash(b"p" + b"".join(leaves))
        codes = base64.urlsafe_b64encode(b"".join(leaf[:_CODE_BYTES] for leaf in leaves)).decode()
        sections[-1].append(codes)
        hashes[-1].append(node)
        if not leaves or node[0] % 8 == 0:
            sections.append([])
            hashes.append([])
    root = _hash(b"r" + b"".join(_hash(b"s" + b"".join(nodes)) for nodes in hashes))
    return f"{root.hex()}:" + "/".join(".".join(section) for section in sections)


def _sections(print_: str) -> list[str]:
    return print_.split(":", 1)[1].split("/")


def _leaves(section: str) -> list[str]:
    return [p[i : i + _CODE_CHARS] for p in section.split(".") for i in range(0, len(p), _CODE_CHARS)]


def likeness(left: str, right: str) -> float:
    """Share of leaves in common, 0 to 1; equal sections are not opened."""
    if left.split(":", 1)[0] == right.split(":", 1)[0]:
        return 1.0
    a, b = Counter(_sections(left)), Counter(_sections(right))
    same = a & b
    shared = sum(len(_leaves(s)) * n for s, n in same.items())
    rest = [Counter(leaf for s, n in (side - same).items() for leaf in _leaves(s) * n) for side in (a, b)]
    total = 2 * shared + sum(rest[0].values()) + sum(rest[1].values())
    return 1.0 if not total else 2 * (shared + sum((rest[0] & rest[1]).values())) / total


def edits(left: str, right: str) -> list[tuple[int, int, int]]:
    """Section, paragraph and leaf (from 0) of every leaf of ``right`` in branches that ``left`` does not have."""
    sections = Counter(_sections(left))
    paragraphs = Counter(p for s in _sections(left) for p in s.split("."))
    leaves = Counter(leaf for s in _sections(left) for leaf in _leaves(s))
    return [
        (i, j, k)
        for i, section in enumerate(_sections(right)) if section not in sections
        for j, paragraph in enumerate(section.split(".")) if paragraph not in paragraphs
        for k, leaf in enumerate(_leaves(paragraph)) if leaf not in leaves
    ]


def located_edits(left: str, right: str) -> list[tuple[str, Place | None, Place | None]]:
    """What leads from ``left`` to ``right``: ``delete``, ``insert`` or ``move``, and the places (section, paragraph, leaf,
    from 0) of the leaf in both. Branches are aligned from the top; only those that differ are opened."""
    def opened(nodes_a: list[Node], nodes_b: list[Node], separator: str) -> Iterator[tuple[list[Node], list[Node]]]:
        matcher = SequenceMatcher(None, [n[1] for n in nodes_a], [n[1] for n in nodes_b], autojunk=False)
        for kind, a, b, c, d in matcher.get_opcodes():
            if kind != "equal":
                yield tuple(
                    [((*place, k), code) for place, node in side for k, code in enumerate(
                        node.split(separator) if separator else
                        [node[i : i + _CODE_CHARS] for i in range(0, len(node), _CODE_CHARS)])]
                    for side in (nodes_a[a:b], nodes_b[c:d]))

    gone: list[Node] = []
    new: list[Node] = []
    tops = ([((i,), section) for i, section in enumerate(_sections(side))] for side in (left, right))
    for sections_a, sections_b in opened(*tops, "."):
        for leaves_a, leaves_b in opened(sections_a, sections_b, ""):
            matcher = SequenceMatcher(None, [n[1] for n in leaves_a], [n[1] for n in leaves_b], autojunk=False)
            for kind, a, b, c, d in matcher.get_opcodes():
                if kind != "equal":
                    gone += leaves_a[a:b]
                    new += leaves_b[c:d]
    arrived: dict[str, list[Place]] = {}
    for place, code in new:
        arrived.setdefault(code, []).append(place)
    moves = [("move", place, arrived[code].pop(0)) for place, code in gone if arrived.get(code)]
    moved = {m[1] for m in moves}
    return (
        [("delete", place, None) for place, _ in gone if place not in moved] + moves
        + [("insert", None, place) for place in sorted(p for places in arrived.values() for p in places)]
    )


def edited_text(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_fingerprint(docs: DataFrame, text: str = "text", into: str = "fingerprint") -> DataFrame:
    """Adds the fingerprint of every text. No shuffle."""

    @F.pandas_udf("string")
    def prints(texts):
        return texts.map(fingerprint)

    return docs.withColumn(into, prints(F.coalesce(F.col(text), F.lit(""))))


_ROW = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_NAMES = [field.split()[0] for field in _ROW.split(", ")]


def _finished(doc_id, text: str, print_: str, next_text: str, next_print: str) -> tuple:
    edited = edited_text(text, next_text)
    edited_print = fingerprint(edited)
    return (
        doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), print_, edited_print,
        likeness(print_, edited_print), likeness(print_, next_print),
    )


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows in; each row finished with the one after it. The first and the last text of the partition come out
    as ``head`` and ``tail``, for the rows across the border."""
    part, held = TaskContext.get().partitionId(), None
    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2, pa.int32(), pa.string(), pa.string()]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [*_NAMES, "part", "border", "text"])

    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            print_ = fingerprint(text)
            if held is None:
                rows.append((doc_id, len(text), None, print_, None, None, None, part, "head", text))
            else:
                rows.append((*_finished(*held, text, print_), None, None, None))
            held = (doc_id, text, print_)
        if rows:
            yield packed(rows)
    if held is not None:
        doc_id, text, print_ = held
        yield packed([(doc_id, len(text), None, print_, None, None, None, part, "tail", text)])


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [
            _finished(r["doc_id"], r["text"], r["fingerprint"], r["next_text"], r["next_print"])
            for r in batch.to_pylist()
        ]
        if rows:
            kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], _NAMES)


def fingerprint_digest(docs: DataFrame) -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and their likeness; likeness to the next document.

    Texts are range partitioned by id and sorted once; a task passes over its partition with one text in hand. What
    crosses a border is one text per partition, joined through the written result.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    tie = [F.col("doc_id").asc_nulls_first(), F.length("text"), F.xxhash64("text")]
    path = new_path(docs.sparkSession, "fingerprints")
    (
        texts.repartitionByRange(*tie).sortWithinPartitions(*tie, "text")
        .mapInArrow(_chained, f"{_ROW}, part int, border string, text string")
        .write.option("compression", "zstd").parquet(path)
    )
    chained = docs.sparkSession.read.schema(f"{_ROW}, part int, border string, text string").parquet(path)
    heads = chained.filter("border = 'head'")
    # One small row per partition: which partition with rows comes next, around the end.
    order = heads.select("part").withColumn("next", F.lead("part").over(Window.orderBy("part"))).withColumn(
        "next", F.coalesce("next", F.min("part").over(Window.partitionBy(F.lit(1)))))
    crossing = (
        chained.filter("border = 'tail'").select("part", "doc_id", "text", "fingerprint").join(order, "part")
        .join(heads.select(F.col("part").alias("next"), F.col("text").alias("next_text"),
                           F.col("fingerprint").alias("next_print")), "next")
        .select("doc_id", "text", "fingerprint", "next_text", "next_print").mapInArrow(_across, _ROW)
    )
    return chained.filter("border is null").select(*_NAMES).unionByName(crossing)
