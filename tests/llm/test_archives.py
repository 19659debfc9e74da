"""Archives, manifest and hard negatives against brute force, with nulls, copies, ties, long texts and empty tables."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from bankflow.llm import hard_negatives, manifest, warc


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# Archives

PAGES = "page_id long, url string, html string, type string, record int, data string"


@pytest.fixture(scope="module")
def pages(spark):
    rng = np.random.default_rng(3)
    noise = "".join(map(chr, rng.integers(32, 0x2FF, 40000)))
    texts = {1: "same", 2: "same", 3: None, 4: "", 5: "a\r\n\r\nWARC/1.0\r\nb", 6: "é" * 500, 7: noise * 20, 8: noise * 20,
             9: "tail\r\n\r\n", 0: "same"}
    rows = [(k, None if k == 4 else f"http://e.org/{k} ü\r\nX: y", t, "t", 1, "d") for k, t in texts.items()]
    rows += [(2, "u", "same", None, 1, None), (None, "u", "same", None, 1, None), (None, "v", "alone", None, 1, None)]
    rows += [(100 + i, "u", "hot", None, 1, None) for i in range(40)]
    return spark.createDataFrame(rows, PAGES)


def test_warc_round_trip(spark, pages):
    rows = [(r["page_id"], (r["html"] or "").encode()) for r in pages.collect()]
    first = {}
    for key, payload in rows:
        first[payload] = min(first.get(payload, (True, 0)), (key is None, key or 0))
    expected, seen = Counter(), set()
    for key, payload in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        lead = first[payload] == (key is None, key or 0) and payload not in seen
        seen.add(payload)
        expected[key, len(payload), digest, "response" if lead else "revisit", None if lead else first[payload][1]] += 1
    found = warc.warc_digest(pages.repartition(3)).collect()
    assert Counter(tuple(r) for r in found) == expected


def test_warc_payloads_come_back_in_chunks(spark, pages, tmp_path):
    chunks = warc.chunk_table(pages, "page_id", "html", "url")
    assert chunks.groupBy("record").count().agg({"count": "max"}).first()[0] > 1
    headers = warc.record_headers(chunks)
    archives = warc.write_archives(chunks, headers, f"file://{tmp_path}/w")
    read = warc.read_archives(archives).collect()
    payloads, running = defaultdict(bytes), {}
    for r in sorted(read, key=lambda r: (r["record"], r["chunk"])):
        payloads[r["record"]] += bytes(r["data"] or b"")
        if r["type"] == "response":
            assert r["bytes"] == len(payloads[r["record"]])
            assert r["digest"] == base64.b32encode(hashlib.sha1(payloads[r["record"]]).digest()).decode()
        running[r["record"]] = r
    texts = {(r["html"] or "").encode() for r in pages.collect()}
    assert {payloads[k] for k, r in running.items() if r["type"] == "response"} == texts
    assert all(len(r["data"] or b"") <= warc.CHUNK_BYTES for r in read)
    assert sum(r["records"] for r in archives.collect()) == pages.count()
    # Any reader of gzip members sees whole records.
    whole = b"".join(gzip.decompress((tmp_path / "w" / p["path"].rsplit("/", 1)[1]).read_bytes()) for p in archives.collect())
    assert whole.count(b"WARC-Record-ID: ") == pages.count()
    assert not any(line.startswith(b"X: y") for line in whole.split(b"\r\n"))


def test_small_copies_are_responses(pages):
    kinds = {r["key"]: r["type"] for r in warc.round_trip(pages, least_bytes=4).collect() if r["key"] is not None}
    assert kinds[139] == "response" and kinds[1] == "revisit" and kinds[8] == "revisit"


def archive_of(payload: bytes, **changes) -> bytes:
    row = {"type": "response", "record": 7, "key": 1, "uri": None, "bytes": len(payload), "refers_record": None,
           "refers_uri": None, "digest": base64.b32encode(hashlib.sha1(payload).digest()).decode()} | changes
    return warc._head(row) + payload + b"\r\n\r\n"


def test_damaged_archives_fail():
    def read(data: bytes) -> list[dict]:
        return list(warc.records_in(gzip.GzipFile(fileobj=io.BytesIO(gzip.compress(data)))))

    good = archive_of(b"payload")
    assert [r["data"] for r in read(good + good)] == [b"payload"] * 2
    for bad in (good[:-9], good[:-2], good.replace(b"payload", b"paxload"), b"junk" + good, archive_of(b"x", digest="A")):
        with pytest.raises((ValueError, EOFError)):
            read(bad)


def test_no_pages(spark):
    assert warc.warc_digest(spark.createDataFrame([], PAGES)).collect() == []


# Manifest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, leaf string, root string, pos long"


def tree(leaves: list[str]) -> tuple[str, list[list[list[str]]]]:
    """Root, and for each leaf its runs from the bottom, each as (left, right)."""
    proofs = [[] for _ in leaves]
    level, under = leaves, [[i] for i in range(len(leaves))]
    while len(level) > 1:
        above, spans = [], []
        for at in range(0, len(level), 3):
            run = level[at : at + 3]
            for k in range(len(run)):
                for leaf in under[at + k]:
                    proofs[leaf].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(h(*run))
            spans.append(sum(under[at : at + 3], []))
        level, under = above, spans
    return level[0], proofs


def leaf_of(row) -> str:
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:1] + (row[3], row[2], row[4], row[1])))


def expected_manifest(rows: list[tuple]) -> Counter:
    groups = defaultdict(list)
    for row in rows:
        groups[row[3]].append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    out, subroots, held = Counter(), [], []
    for source in order:
        members = sorted(groups[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        subroot, proofs = tree([leaf_of(r) for r in members])
        subroots.append(subroot)
        held.append((members, subroot, proofs))
    root, upper = tree(subroots)
    for (members, subroot, proofs), above in zip(held, upper, strict=True):
        for row, proof in zip(members, proofs, strict=True):
            present = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[1] is not None:
                present = (row[0], row[1].replace("\n", ""), *row[2:])
            end = leaf_of(present)
            for left, right in proof + above:
                end = h(left, end, right)
            siblings = h(*(s for step in proof + above for s in step))
            out[row[0], leaf_of(row), subroot, root, siblings, end, end == root] += 1
    return out


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_manifest(spark, monkeypatch, levels):
    """Blocks smaller than the sources, so that proofs go through several rounds; one source has most rows."""
    monkeypatch.setattr(manifest, "BLOCK_LEVELS", levels)
    monkeypatch.setattr(manifest, "BLOCK", 3**levels)
    rows = [(i, f"line {i}\nend" if i % 3 else "flat", "en", ["hot", "b", "é", None][min(i % 7, 3)] if i % 2 else "hot", i)
            for i in range(95)]
    rows += [(200 + i, "x\ny", None, f"s{i}", None) for i in range(12)]
    rows += [(500, None, "en", "nine", 1), (501, "", "en", "nine", 1)] + [(510 + i, "n", "en", "nine", 1) for i in range(7)]
    rows += [(3, rows[3][1], "en", "hot", 3), (3, "other", "en", "hot", 3), (None, "a\nb", "en", "hot", None), (900, "w " * 50000 + "\n", "x", "", 2)]
    rows += [rows[0], rows[0]]
    table = spark.createDataFrame([(*r, "clash", "clash", 1) for r in rows], DOCS)
    found = manifest.manifest_digest(table.repartition(3)).collect()
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    assert Counter(tuple(r[n] for n in names) for r in found) == expected_manifest(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28])
def test_manifest_of_one_source(spark, monkeypatch, n):
    monkeypatch.setattr(manifest, "BLOCK_LEVELS", 1)
    monkeypatch.setattr(manifest, "BLOCK", 3)
    rows = [(i, "t\n", "en", "s", i) for i in range(n)]
    found = manifest.manifest_digest(spark.createDataFrame([(*r, "", "", 1) for r in rows], DOCS)).collect()
    assert Counter(tuple(r) for r in found) == expected_manifest(rows)


def test_manifest_of_nothing(spark):
    assert manifest.manifest_digest(spark.createDataFrame([], DOCS)).collect() == []


def test_blocks_hold_few_messages():
    digests = [h(str(i)) for i in range(manifest.BLOCK)]
    root, proofs = tree(digests)
    found, visited = manifest.forward(digests, manifest.BLOCK_LEVELS)
    assert found == root
    assert manifest.backward(visited, "")[5] == "/".join(f"{a}.{b}" for a, b in proofs[5])


# Hard negatives

VECTORS = "vec_id long, label int, embedding array<float>, score long, row int, dim int"


def mined(rows: list[tuple]) -> list[tuple]:
    held = []
    for vec_id, label, vector in rows:
        if None in (vec_id, label, vector) or any(x is None or not np.isfinite(x) for x in vector):
            continue
        held.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, [int(np.floor(256 * float(x))) for x in vector]))
    out = []
    for at, (anchor, label, vector) in enumerate(held):
        if anchor % 100:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(vector, other[2], strict=True)), other[0], k) for k, other in enumerate(held)
            if k != at and len(other[2]) == len(vector))
        for score, positive, _ in [s for s in scored if held[s[2]][1] == label][:5]:
            falling = [s for s in scored if held[s[2]][1] != label and 30 * -score <= 100 * -s[0] <= 90 * -score][:10]
            out += [(anchor, positive, r, n[1], -score, -n[0]) for r, n in enumerate(falling, 1)]
    return sorted(out)


def vectors(seed: int, n: int, dim: int = 6, scale: float = 1.0) -> list[list[float]]:
    """Few distinct values, so that scores tie."""
    rng = np.random.default_rng(seed)
    return (rng.integers(-2, 6, (n, dim)) * scale / 8).astype(np.float32).tolist()


@pytest.mark.parametrize("scale", [1.0, 3e4, 2e6])
def test_hard_negatives(spark, monkeypatch, scale):
    monkeypatch.setattr(hard_negatives, "BLOCK_VALUES", 200)
    monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", 2)
    rng = np.random.default_rng(9)
    rows = [(int(i), int(rng.choice([1, 1, 2, 3, 9])), v) for i, v in zip(range(0, 2400, 12), vectors(1, 200, 6, scale), strict=True)]
    rows += [(100, 1, rows[3][2]), (300, None, rows[0][2]), (500, 1, None), (700, 1, [1.0, None, 0.0, 0.0, 0.0, 0.0]),
             (1100, 1, [float("nan")] * 6), (1300, 2, [float("inf")] * 6), (None, 1, rows[0][2]), (1500, 4, [1.0, 2.0]),
             (1501, 4, [1.0, 2.0]), (1502, 5, [1.0, 1.0]), (1700, 3, []), (1900, 1, [0.0] * 6), (2100, 1, [-0.5] * 6)]
    table = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], VECTORS)
    found = hard_negatives.hard_negatives_digest(table.repartition(3)).collect()
    expected = mined(rows)
    assert len(expected) > 300 and sorted(tuple(r) for r in found) == expected


def test_a_label_with_nearly_all_rows(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK_VALUES", 300)
    rows = [(i, 1 if i % 10 else 2, v) for i, v in enumerate(vectors(4, 401))]
    table = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], VECTORS)
    assert sorted(tuple(r) for r in hard_negatives.hard_negatives_digest(table).collect()) == mined(rows)


def test_no_vectors(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert hard_negatives.hard_negatives_digest(empty).collect() == []
    lonely = spark.createDataFrame([(1, 1, [1.0], 1, 1, 1), (100, 1, [1.0], 1, 1, 1)], VECTORS)
    assert hard_negatives.hard_negatives_digest(lonely).collect() == []


def test_keys_sort_by_their_bytes():
    rng = np.random.default_rng(2)
    numbers = [rng.integers(-(2**62), 2**62, 300) for _ in range(3)]
    anchors = rng.integers(-2, 3, 300)
    keys = hard_negatives._keys([hard_negatives.packed(anchors, anchors, numbers[0] >> 58, 1, numbers[1], numbers[2])])
    found = [hard_negatives.unpacked(k) for k in sorted(keys.column("key").to_pylist())]
    assert found == sorted(found, key=lambda k: (k[0], k[1], -k[2], k[3], k[4], k[5]))
    assert sorted(f[4] for f in found) == sorted(numbers[1].tolist())


def test_scores_are_exact():
    a = np.array([[2.0**40, -(2.0**40)]])
    with pytest.raises(OverflowError):
        hard_negatives.products(a, a)
    b = np.array([[2.0**30 + 1, 3.0]])
    assert hard_negatives.products(b, b)[0, 0] == (2**30 + 1) ** 2 + 9
    assert isinstance(hard_negatives._keys([hard_negatives.packed([1], [1], [1], 0, [1], [1])]), pa.RecordBatch)
