"""Corpus operators against brute force, on small tables with nulls, empty texts, copies, ties and clashing columns."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bankflow.llm import bpe, fingerprints, line_dedup, mixing, near_dup, pii, quality_model, quality_rules, sharding
from bankflow.llm import toxicity
from bankflow.llm.linking import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans string, size long, row long, n int"
WORDS = [a + b + "k" for a in "aeiouy" for b in "bdfglmnprs"]


def prose(seed: int, n: int = 60) -> list[str]:
    rng = np.random.default_rng(seed)
    return [WORDS[i] for i in rng.integers(0, len(WORDS), n)]


@pytest.fixture(scope="module")
def docs(spark):
    base = prose(1, 80)
    near = base[:40] + ["other"] + base[41:]
    texts = [
        " ".join(base), " ".join(base), " ".join(near), " ".join(prose(2)), None, "", "one", " \t ",
        "Mail a.b@c.org, b@d.e.f_x@y.zz or +1 (555) 010-9999; card 4111 1111 1111 1111, ip 10.0.0.255 and 1.2.3.999.\n"
        "IBAN DE89370400440532013000",
        "word " * 3000, "x" * 20000, "a line that many texts have in common\n" + " ".join(prose(3)),
        "A line that many texts have in common!\n" + " ".join(prose(4)), "\U0001f600 é" * 30,
    ]
    rows = [(i, t, "en", "s%d" % (i % 3) if i % 5 else None, None, "clash", 1, 2, 3) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, "no id here", "en", "s1", None, "clash", 1, 2, 3)]
    return spark.createDataFrame(rows, SCHEMA)


def texts_of(docs) -> list[tuple]:
    return [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]


def base_spans(text: str) -> list[tuple]:
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c.isdigit()]
        luhn = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits)))
        if 13 <= len(digits) <= 19 and luhn % 10 == 0:
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def test_pii(docs):
    expected = sorted((str(i), ",".join("%s:%d:%d" % s for s in base_spans(t))) for i, t in texts_of(docs))
    found = pii.pii_digest(docs).collect()
    assert sorted((str(r["doc_id"]), r["base_sha256"]) for r in found) == sorted(
        (i, hashlib.sha256(s.encode()).hexdigest()) for i, s in expected)
    spans = next(r["spans"] for r in found if r["doc_id"] == 8)
    assert "iban:" in spans and spans.startswith("email:5:14,")


def test_pii_long_runs(spark):
    texts = ["a" * 60000, "1" * 60000, "a@" + "b." * 20000 + "c", "1 " * 30000, "+1" + " " * 60000]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"]: r["n_email"] for r in pii.pii_digest(table).collect()}[2] == 1


def test_redact(spark):
    table = spark.createDataFrame([(1, "to a@b.cc now"), (2, None)], "doc_id long, text string")
    done = {r["doc_id"]: r["text"] for r in pii.redact(pii.find_pii(table)).collect()}
    assert done == {1: "to [email] now", 2: None}


def test_bpe(docs, spark):
    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = bpe.tokenize(docs).select("doc_id", "text", "ids", "decoded", "spans").collect()
    assert len(found) == docs.count() and all(r["spans"] == "clash" for r in found)
    for r in found:
        assert r["ids"] == plain.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]) == (r["text"] or "").encode()


def test_pii_positions_of_many_spans(spark):
    """More spans than a chunk, whole texts; the last one is where it should be."""
    many = " ".join(f"{i} a{i}@b.org" for i in range(700))
    table = spark.createDataFrame([(1, many), (2, "é" * 9 + many), (3, "a@b.org" * 3)], "doc_id long, text string")
    for r in pii.pii_digest(table).collect():
        text = {1: many, 2: "é" * 9 + many, 3: "a@b.org" * 3}[r["doc_id"]]
        expected = [(k, a, b) for k, a, b in base_spans(text)]
        assert r["n_email"] == sum(k == "email" for k, _, _ in expected)
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in expected).encode()).hexdigest()


def test_pii_added_kinds(spark):
    """Checksum or context decides; words after a span count too, far ones do not."""
    secret = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    texts = {
        1: f'token = "{secret}" and on', 2: f"commit {secret}", 3: f"{secret} is the API key", 4: "password: hunter2",
        5: f"token {'far away ' * 9}{secret}", 6: "the secret passwordless_authentication_methods", 7: "ssn 123-45-6789",
        8: "part 123-45-6789", 9: "123-45-6789 (social security)", 10: "call 555-123-4567 or 555-123-4568",
        11: "IBAN DE89370400440532013000 and DE89370400440532013001", 12: None, 13: "",
    }
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii.pii_digest(table).collect()}
    kinds = {i: [s.split(":")[0] for s in r["spans"].split(",") if s] for i, r in found.items()}
    assert kinds == {1: ["secret"], 2: [], 3: ["secret"], 4: [], 5: [], 6: [], 7: ["national_id"], 8: [],
                     9: ["national_id"], 10: ["local_phone"] * 2, 11: ["iban"], 12: [], 13: []}
    at = texts[1].index(secret)
    assert found[1]["spans"] == f"secret:{at}:{at + 40}" and found[1]["n_secret"] == found[1]["n_spans"] == 1
    assert pii.pii_digest(table.limit(0)).collect() == []


def test_sharding(docs):
    found = sharding.shard_digest(docs, 4).collect()
    texts = sorted((str(i), len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in texts_of(docs))
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in found) == texts
    for shard in {r["shard"] for r in found}:
        slots = sorted(r["slot"] for r in found if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_slot_map_edits(spark, tmp_path):
    loads = [7 * i % 101 + 1 for i in range(400)]
    first = sharding.balanced(loads, 8)
    grown = sharding.edited(loads, first, 9)
    assert {new for old, new in zip(first, grown, strict=True) if old != new} == {8}
    totals = [sum(x for x, s in zip(loads, grown, strict=True) if s == k) for k in range(9)]
    assert max(totals) <= 1.05 * sum(totals) / 9
    kept = sharding.SlotMap(spark, str(tmp_path / "map"))
    kept.write(1, first)
    kept.write(2, grown)
    assert kept.owner(1) == first and kept.owner(2) == grown


def test_rebalancing_edits_the_map(spark, tmp_path):
    """Grown texts and a new shard: the next version of the map has near equal shards, and only whole slots move."""
    path = str(tmp_path / "map")
    rows = [(i, "x" * (i * 37 % 900)) for i in range(4000)] + [(5000, "same")] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    placed = sharding.shard(docs, 6, path).collect()
    sizes = Counter()
    for r in placed:
        sizes[r["shard"]] += r["size"]
    assert max(sizes.values()) - min(sizes.values()) <= 2000 and len(placed) == len(rows)
    records = sharding.records_of(docs.withColumn("text", F.when(F.col("doc_id") < 300, F.repeat("text", 3)).otherwise(F.col("text"))))
    for shards, version in ((6, 2), (7, 3)):
        moved = sharding.rebalance(records, path, shards).collect()
        sizes, owners = Counter(), {}
        for r in moved:
            sizes[r["shard"]] += r["size"]
            assert owners.setdefault(r["virtual_slot"], (r["old_shard"], r["shard"])) == (r["old_shard"], r["shard"])
        mean = sum(sizes.values()) / shards
        assert len(moved) == len(rows) and len(sizes) == shards
        assert all(abs(n - mean) <= 0.03 * mean for n in sizes.values())
        assert sharding.SlotMap(spark, path).latest() == version
    assert all(r["shard"] in (r["old_shard"], 6) for r in moved)
    assert sharding.shard_digest(docs.limit(0)).collect() == []


def test_mixing(spark):
    rows = [(i, " ".join(prose(i, 1 + i % 9)), f"s{i % 4}" if i % 11 else None) for i in range(300)] + [(None, None, "s9")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix_digest(table).collect()
    assert sorted(map(str, found)) == sorted(map(str, mixing.mix_digest(table.repartition(3)).collect()))
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    order = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    budget, targets, open_ = 1.5 * sum(sizes.values()), {}, set(order)
    while True:
        level = (budget - sum(targets.values())) / sum(weights[s] for s in open_)
        above = {s for s in open_ if level * weights[s] > 2 * sizes[s]}
        targets |= {s: 2.0 * sizes[s] for s in above}
        open_ -= above
        if not above:
            break
    targets |= {s: level * weights[s] for s in open_}
    taken, source_of = Counter(), {i: s for i, _, s in rows}
    for r in found:
        source = source_of[r["doc_id"]]
        assert r["target"] == pytest.approx(targets[source]) and r["source_size"] == sizes[source]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[source] += r["taken"]
    assert all(abs(taken[s] - targets[s]) <= 12 for s in order)


def test_fingerprints(docs):
    rows = sorted(texts_of(docs), key=lambda r: (r[0] is not None, r[0] or 0, len(r[1])))
    expected = Counter()
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1], strict=True):
        edited = fingerprints.edited_text(text, following)
        expected[i, hashlib.sha256(edited.encode()).hexdigest(), fingerprints.fingerprint(edited)] += 1
    for parts in (1, 5):
        found = fingerprints.fingerprint_digest(docs.repartition(parts)).collect()
        assert Counter((r["doc_id"], r["edited_sha256"], r["edited_fingerprint"]) for r in found) == expected


def test_fingerprint_locates_edits():
    text = "First here. Second one.\nThird line is here.\n\nFourth. Fifth."
    a, b = fingerprints.fingerprint(text), fingerprints.fingerprint(text.replace("Second one", "Changed"))
    assert fingerprints.likeness(a, a) == 1.0 and 0.5 < fingerprints.likeness(a, b) < 1.0
    assert [edit[2] for edit in fingerprints.edits(a, b)] == [1]
    assert fingerprints.fingerprint("a\nb") != fingerprints.fingerprint("ab")


def test_fingerprint_locates_deletions_moves_and_copies():
    sentences = [f"Sentence number {i} of this text." for i in range(12)]
    lines = ["  ".join(sentences[i : i + 3]) for i in range(0, 12, 3)]
    text = "\n\n".join(lines)

    def changes(other: str) -> list[str]:
        return [kind for kind, _, _ in fingerprints.located_edits(fingerprints.fingerprint(text), fingerprints.fingerprint(other))]

    assert changes(text) == []
    assert changes(text.replace(sentences[4] + "  ", "")) == ["delete"]
    assert changes(text + "\n\nA new end.") == ["insert"]
    assert sorted(changes(text.replace(sentences[4], "Changed."))) == ["delete", "insert"]
    assert set(changes("\n\n".join([lines[1], lines[0], *lines[2:]]))) == {"move"}
    copied = changes(text.replace(sentences[7], sentences[1]))
    assert sorted(copied) == ["delete", "insert"]
    first = fingerprints.located_edits(fingerprints.fingerprint("A. B. C."), fingerprints.fingerprint("A. X. C."))
    assert first == [("delete", (0, 0, 1), None), ("insert", None, (0, 0, 1))]
    swapped = fingerprints.fingerprint("\n\n".join([lines[1], lines[0], *lines[2:]]))
    assert fingerprints.likeness(fingerprints.fingerprint(text), swapped) == 1.0 and swapped != fingerprints.fingerprint(text)


def test_line_dedup(docs):
    clean = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs).collect()}
    assert clean[11]["removed_lines"] == [] and clean[12]["removed_lines"] == [0]
    assert clean[0]["removed_lines"] == [] and clean[1]["text"] == "" and clean[2]["text"] == ""
    assert clean[4]["text"] is None and clean[6]["text"] == "one" and clean[12]["spans"] == "clash"


def edit_distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_edit_distance_of_lines():
    rng = np.random.default_rng(8)
    pool = ["", "a", "ab", "ba", "é", "kitten", "sitting", "aaaa", "aaab", "x" * 70 + "y", "y" + "x" * 70, " ".join(prose(3, 40))]
    pool += ["".join(rng.choice(list("abé "), int(n))) for n in rng.integers(1, 90, 25)]
    for x in pool:
        for y in pool:
            assert line_dedup.edit_distance(x, y) == edit_distance(x, y)


def test_edit_distances_of_many_pairs():
    rng = np.random.default_rng(9)
    for size in (1, 5, 63, 64, 65, 128, 200):
        first = ["".join(rng.choice(list("abé "), size)) for _ in range(3)]
        pairs = [(a, "".join(rng.choice(list("abé x"), int(n)))) for a in range(3) for n in rng.integers(1, 2 * size + 2, 8)]
        # Copies with some letters changed, put in or left out.
        for a, changes in [(a, k) for a in range(3) for k in (0, 1, size // 10, size // 5, size // 3)]:
            copy = list(first[a])
            for at in rng.integers(0, size, changes):
                copy[at] = copy[at] if len("".join(copy)) <= 1 else str(rng.choice(["", "x", f"{copy[at]}y"]))
            pairs.append((a, "".join(copy)))
        texts = [*first, *(b for _, b in pairs)]
        flat = np.unique(np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32), return_inverse=True)[1]
        length = np.array([len(t) for t in texts])
        begin, of_a = np.cumsum(length) - length, np.array([a for a, _ in pairs])
        allowed = np.maximum(length[of_a], length[3:]) // 5
        found = line_dedup.within_distance(flat, (begin[:3], length[:3]), of_a, begin[3:], length[3:], allowed)
        assert found.tolist() == [edit_distance(first[a], b) <= n for (a, b), n in zip(pairs, allowed.tolist(), strict=True)]
        # The same with few pairs at once.
        for k in range(0, len(pairs), 2):
            one = slice(k, k + 2)
            assert found[one].tolist() == line_dedup.within_distance(
                flat, (begin[:3], length[:3]), of_a[one], begin[3:][one], length[3:][one], allowed[one]).tolist()


def test_near_lines_are_found_wherever_they_differ(spark):
    """One word in five, or in ten, is changed, also in the first and last two words; brute force over all pairs."""
    check_near_lines(spark, 5, 0.75)
    check_near_lines(spark, 10, 0.95)


def check_near_lines(spark, every: int, recall: float):
    rng, lines = np.random.default_rng(5), []
    for n in (5, 6, 7, 8, 9, 10, 12, 15, 16, 20, 24, 25, 32, 40, 50, 60):
        for k in range(4):
            base = prose(1000 + 10 * n + k, n)
            copy = list(base)
            changed = {0, n - 1} if k == 0 and n >= 10 else set(rng.choice(n, max(1, n // every), replace=False).tolist())
            for at in changed:
                copy[at] = f"{copy[at][:-1]}zu"
            lines += [" ".join(base), " ".join(copy)]
    table = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    removed = {r["doc_id"] for r in line_dedup.dedup_lines(table).collect() if r["removed_lines"]}
    root = list(range(len(lines)))
    for a, x in enumerate(lines):
        for b, y in enumerate(lines[:a]):
            allowed = (max(len(x), len(y)) + 0.0) * 0.2 + 1e-9
            if abs(len(x) - len(y)) <= allowed and sum((Counter(x) - Counter(y)).values()) <= allowed and (
                    edit_distance(x, y) <= allowed):
                root = [min(root[a], root[b]) if r in (root[a], root[b]) else r for r in root]
    expected = {i for i, r in enumerate(root) if r != i}
    assert len(expected) >= 50 and removed <= expected
    assert len(removed) >= recall * len(expected)


def test_near_lines_are_found_without_a_word_in_common(spark, monkeypatch):
    """One letter is changed in each word, or letters are put in at the end of it, in texts of many lengths and several
    cells; the same groups as by brute force over all pairs."""
    monkeypatch.setattr(line_dedup, "CELL_CHARACTERS", 400)
    monkeypatch.setattr(line_dedup, "STEPS_AT_ONCE", 2)
    rng, lines = np.random.default_rng(11), []
    for n in (5, 6, 9, 14, 22, 40):
        for _ in range(4):
            base = ["".join(rng.choice(list("abcdefghijklmnopéß"), int(k))) for k in rng.integers(6, 11, n)]
            lines += [" ".join(base), " ".join(f"{w[:3]}zy{w[4:]}" if len(w) > 9 else f"{w[:3]}z{w[4:]}" for w in base),
                      " ".join(f"{w}x" for w in base)]
    table = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    removed = {r["doc_id"] for r in line_dedup.dedup_lines(table).collect() if r["removed_lines"]}
    root = list(range(len(lines)))
    for a, x in enumerate(lines):
        for b, y in enumerate(lines[:a]):
            if abs(len(x) - len(y)) * 5 <= max(len(x), len(y)) and edit_distance(x, y) * 5 <= max(len(x), len(y)):
                root = [min(root[a], root[b]) if r in (root[a], root[b]) else r for r in root]
    assert removed == {i for i, r in enumerate(root) if r != i} and len(removed) >= 40


def test_few_pairs_of_unlike_lines_are_verified(monkeypatch):
    """Lines of the same syllables: the links of brute force, though hardly any other pair gets to the edit distances."""
    rng = np.random.default_rng(13)
    syllables = ["the ", "ing ", "er", "on", "at ", "en", "of ", "th", "re", "an ", "tion ", "ea", "nd ", "ha", "ly ", "st"]

    def edited(line: str, edits: int) -> str:
        letters = list(line)
        for at in rng.choice(len(letters), edits, replace=False):
            letters[at] = str(rng.choice(["", "x", letters[at] + "x"]))
        return "".join(letters)

    verified = []
    within_distance = line_dedup.within_distance

    def counted(flat, a, of_a, *rest):
        verified.append(len(of_a))
        return within_distance(flat, a, of_a, *rest)

    monkeypatch.setattr(line_dedup, "within_distance", counted)
    for size, most in ((10, 1), (30, 0.06), (90, 0.06), (220, 0.25), (420, 0.25)):
        base = ["".join(rng.choice(syllables, int(n)))[:size] for n in rng.integers(size // 2, size, 60)]
        # Edits all over the line, up to what is allowed and beyond; letters that all others move by, and repeats of one run.
        lines = base + [edited(x, int(len(x) * share)) for x in base[:12] for share in (0.1, 0.19, 0.2, 0.24)]
        lines += [x[len(x) // 5 :] for x in base[12:18]] + [x[: size // 2] + "the " * (size // 25) + x[size // 2 :] for x in base[18:24]]
        lines += [("ab " * size)[: len(x)] for x in base[24:30]]
        lines = list(dict.fromkeys(x for x in lines if x))
        for side in (np.zeros(len(lines), int), np.arange(len(lines)) % 2):
            expected, root, verified[:] = list(range(len(lines))), list(range(len(lines))), []
            for a, x in enumerate(lines):
                for b, y in enumerate(lines[:a]):
                    longer = max(len(x), len(y))
                    if (not side.any() or side[a] != side[b]) and abs(len(x) - len(y)) * 5 <= longer and (
                            line_dedup.edit_distance(x, y) * 5 <= longer):
                        expected = [min(expected[a], expected[b]) if r in (expected[a], expected[b]) else r for r in expected]
            ids = np.arange(len(lines))
            for a, b in line_dedup._links_of_cells(lines, ids, ids.copy(), side):
                root = [min(root[a], root[b]) if r in (root[a], root[b]) else r for r in root]
            near = len(lines) - len(set(expected))
            assert root == expected and near >= 15
            assert sum(verified) <= near * 3 + most * len(lines) ** 2 / 2


def test_long_lines_of_few_syllables_are_ruled_out(monkeypatch):
    """Lines of 400 to 1,500 letters that share most of their runs: near copies are linked, and only a part of the other pairs is verified."""
    rng = np.random.default_rng(14)
    syllables = ["the ", "ing ", "er", "on", "at ", "en", "of ", "th", "re", "an ", "tion ", "ea", "nd ", "ha", "ly ", "st", "sh", "is "]
    verified = []
    within_distance = line_dedup.within_distance

    def counted(flat, a, of_a, *rest):
        verified.append(len(of_a))
        return within_distance(flat, a, of_a, *rest)

    monkeypatch.setattr(line_dedup, "within_distance", counted)
    for size, most in ((400, 0.1), (900, 0.35), (1500, 1)):
        base = ["".join(rng.choice(syllables, size))[:size] for _ in range(150)]
        lines, family = list(base), list(range(150))
        fifth = size // 5

        def copy(text: str, of: int) -> None:
            if line_dedup.edit_distance(text, base[of]) * 5 <= max(len(text), size):
                lines.append(text)
                family.append(of)

        for k in range(0, 60, 5):
            letters = list(base[k])
            # Spread evenly, so that every part has its share; then all in one place; then the whole line moved.
            for at in range(2, size - 3, 5):
                letters[at] = "x"
            copy("".join(letters), k)
            copy(f"{base[k + 1][: size // 3]}{'x' * fifth}{base[k + 1][size // 3 + fifth :]}", k + 1)
            copy(base[k + 2][fifth:], k + 2)
            copy(base[k + 3][: size // 2] + "th on " * (fifth // 6) + base[k + 3][size // 2 :], k + 3)
            copy("th" * (fifth // 4) + base[k + 4][: size - fifth // 2], k + 4)
        for side in (np.zeros(len(lines), int), np.arange(len(lines)) >= 150):
            verified[:] = []
            ids = np.arange(len(lines))
            links = line_dedup._links_of_cells(lines, ids, ids.copy(), side.astype(int))
            assert len(lines) >= 200 and {frozenset(x) for x in links} == {
                frozenset((i, of)) for i, of in enumerate(family) if i >= 150}
            assert sum(verified) <= len(links) + most * len(lines) ** 2 / 2


def test_lines_are_not_written_again_for_each_step(spark, monkeypatch):
    """Tables and shuffles together, with two cells and with dozens: more steps must not deal the texts out more often."""
    rng = np.random.default_rng(12)
    letters = list("abcdefghijklmnopqrstuvwxyzαβγδεζηθικλμνξοπρστυφχψω")
    # Lines of few letters each, so that the letters rule out most pairs.
    alphabets = [rng.choice(letters, 8, replace=False) for _ in range(260)]
    lines = [" ".join("".join(rng.choice(own, 8)) for _ in range(160)) for own in alphabets]
    table = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [Path(spark.conf.get("spark.checkpoint.dir")), *map(Path, manager.localDirsString())]

    def written(cell_characters: int) -> int:
        monkeypatch.setattr(line_dedup, "CELL_CHARACTERS", cell_characters)
        old = {path for folder in folders for path in folder.rglob("*") if path.suffix in (".parquet", ".data")}
        assert line_dedup.line_dedup_digest(table).filter("n_removed > 0").count() == 0
        return sum(path.stat().st_size for folder in folders for path in folder.rglob("*")
                   if path.suffix in (".parquet", ".data") and path not in old)

    assert written(12_000) < 2 * written(1_000_000)


def test_near_lines_of_documents_without_an_id_and_of_equal_rows(spark):
    line = " ".join(prose(21, 30))
    near, far = f"{line[:-1]}z", " ".join(prose(22, 30))
    rows = [(None, f"{far}\n{near}"), (None, f"{far}\n{near}"), (3, line), (3, line), (None, "no line\n" + far + "\n" + line)]
    found = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    # Of documents without an id, the one with the least hash of its text comes first.
    removed = [(r["doc_id"], r["text"], r["removed_lines"]) for r in found]
    assert [r for r in removed if r[0] == 3] == [(3, "", [0])] * 2
    assert sorted(x[2] for x in removed if x[0] is None) in ([[], [], [1, 2]], [[], [0, 1], [0, 1]])


def test_short_lines_go_as_exact_repeats_only(spark):
    rows = [(1, "Call us now\nread on"), (2, "call  us now!"), (3, "call us new"), (4, "\n \nread on\n"), (None, "read on")]
    found = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["removed_lines"] for r in found} == {None: [], 1: [1], 2: [0], 3: [], 4: [2]}


def test_lines_of_nothing_and_of_long_texts(spark):
    table = spark.createDataFrame([], "doc_id long, text string")
    assert line_dedup.line_dedup_digest(table).collect() == []
    lines = [" ".join(prose(i, 25)) for i in range(1000)]
    long = "\n".join(lines + lines[:50]) + "\n" + "word " * 60000
    rows = [(1, long), (2, " ".join(prose(7, 25)).upper() + ".\nword " + "word " * 59999)]
    found = {r["doc_id"]: r["removed_lines"] for r in line_dedup.dedup_lines(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1] == list(range(1000, 1050)) and found[2] == [0, 1]


def test_lines_that_differ_in_numbers_are_verified(spark):
    rows = [(1, "12 45 78 90 11"), (2, "33 62 10 55 47"), (3, "row 12 45 78 90 11 16 27 38"), (4, "row 33 62 10 55 47 84 91 60"),
            (5, "the order of day 12 was sent to the same old town"), (6, "the order of day 13 was sent to the same old town"),
            (7, "at 10:15:07 user 1204 of group 7 logged in from the address 10.0.0.1 in time"),
            (8, "at 10:15:08 user 1205 of group 8 logged in from the address 10.0.0.2 in time"),
            (9, "page 17 of the report"), (10, "page 18 of the report")]
    found = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in found if r["removed_lines"]} == {6, 8, 10}


def test_line_sketches():
    """Each line's sketch depends on its words alone; bits and keys by definition from the hashes of single words."""
    rng = np.random.default_rng(6)
    texts = ["", "\n \n", "one", "a b c d e\n\n f  g\n", " ".join(prose(1, 700)) + "\n" + "é ü" * 9]
    texts += ["\n".join(" ".join(prose(int(s), int(n))) for s, n in zip(rng.integers(0, 99, 5), rng.integers(1, 30, 5), strict=True))
              for _ in range(20)]

    def sketches(many: list[str]) -> list[dict]:
        data = np.frombuffer("".join(many).encode(), np.uint8)
        bounds = np.concatenate([[0], np.cumsum([len(t.encode()) for t in many])])
        found = line_dedup.line_sketches(data, bounds)
        return [dict(zip(found, values, strict=True)) for values in zip(*(v.tolist() for v in found.values()), strict=True)]

    found = sketches(texts)
    lines = [(row, pos, line) for row, t in enumerate(texts) for pos, line in enumerate(t.split("\n")) if line.split()]
    assert [(f["row"], f["pos"]) for f in found] == [(row, pos) for row, pos, _ in lines]
    word = {w: sketches([w])[0]["simhash"] for _, _, line in lines for w in line.split()}
    for f, (_, _, line) in zip(found, lines, strict=True):
        words = line.split()
        assert f["length"] == len(line.strip()) and f["fuzzy"] == (len(words) >= 5)
        assert f["simhash"] == sum(1 << k for k in range(64) if 2 * sum(word[w] >> k & 1 for w in words) > len(words))
        alone = sketches([" ".join(words)])[0]
        assert all(f[name] == alone[name] for name in ("class_a", "class_b", "key_0", "key_4"))
    one, other, rows = (sketches([t])[0] for t in ("paid 12 of 45 today ok", "paid 77 of 10 today ok", "1 22 333 4444 a"))
    assert one["class_a"] != other["class_a"] and one["simhash"] == other["simhash"] and one["key_0"] == other["key_0"]
    assert rows["simhash"] != sketches(["5 66 777 8888 a"])[0]["simhash"]
    assert len({f["class_a"] for f in found}) == len({f["class_b"] for f in found}) == len({" ".join(t.split()) for _, _, t in lines})


def test_components(spark):
    edges = [(9, 3), (3, 7), (7, 1), (20, 21), (22, 21), (5, 5)]
    found = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {1: 1, 3: 1, 7: 1, 9: 1, 20: 20, 21: 20, 22: 20}


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates(spark, words):
    rng = np.random.default_rng(7)
    base, rows = prose(50, 120), []
    for i in range(60):
        text = list(base)
        for at in rng.integers(0, len(text), int(rng.integers(0, 8))):
            text[at] = f"e{rng.integers(0, 1000)}"
        rows.append((i, " ".join(text)))
    rows += [(100 + i, " ".join(prose(200 + i))) for i in range(30)] + [(3, rows[3][1]), (200, None), (201, "Solo"), (202, "solo")]
    sets = {}
    for i, text in rows:
        w = (text or "").lower().split()
        sets[i] = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    found = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words).collect()
    assert len(found) == len(rows)
    assert {r["doc_id"]: r["component_id"] for r in found} == root
    assert all(r["n_shingles"] == len(sets[r["doc_id"]]) for r in found)


def test_near_duplicates_of_nothing(spark):
    table = spark.createDataFrame([], "doc_id long, text string")
    assert near_dup.near_duplicates(table).collect() == []


def test_quality_rules(docs):
    for r in quality_rules.quality_digest(docs).collect():
        text = dict(texts_of(docs))[r["doc_id"]]
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        places = defaultdict(list)
        for i in range(len(words) - 7):
            places[tuple(words[i : i + 8])].append(i)
        covered = {k for at in places.values() if len(at) > 1 for i in at for k in range(i, i + 8)}
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"]) == (len(words), sum(map(len, words)), len(covered))
        assert r["base_failed"] == (len(words) < 20 or 100 * len(covered) > 30 * len(words))
    junk = quality_rules.quality_rules(docs.limit(1).withColumn("text", F.lit("word*** other### here$$$ " * 1 + "a b c d " * 6)))
    assert junk.first()["kept"] is False


def test_line_rules(spark):
    """One line at a time: closing marks, navigation, boilerplate in short and long lines."""
    lines = {
        "a sentence of several plain words ends here.": False, "a row of bare words without any end": True,
        "five bare words stand here": False, "Home About Contact Products": True, "Home About contact Products": False,
        "A Title Of Four Words.": False, "one | two | three | four": True, "he said (and he meant it all) ": False,
        "she asked whether that was so\u201d  ": False, "We use cookies": True, "BUY NOW OR NEVER AGAIN": True,
        "Subscribe here, sign up there, and click here for all that we have in our shop, all rights reserved, and our cookie "
        "policy with the privacy policy.": True,
        "It was long ago that he had to click here, as the story goes, and nothing came of it but a tale that was told to "
        "children at night by the fire.": False, "": False, "   ": False,
    }
    table = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    found = {r["line"]: r["fails"] for r in table.select("line", quality_rules.line_fails(F.col("line")).alias("fails")).collect()}
    assert found == lines
    words = "\n".join(" ".join(prose(k, 12)) for k in range(13))
    kept = spark.createDataFrame([(1, words), (2, words.replace("\n", ".\n") + ".")], "doc_id long, text string")
    assert {r["doc_id"]: r["kept"] for r in quality_rules.quality_digest(kept).collect()} == {1: False, 2: True}
    assert quality_rules.quality_digest(kept.limit(0)).collect() == []


def test_toxicity_reads_misspellings():
    rng = np.random.default_rng(1)
    clean = [" ".join(prose(int(i))) for i in rng.integers(0, 10**6, 200)]
    toxic = [t.replace(f" {WORDS[1]} ", " blockhead ").replace(f" {WORDS[2]} ", " scoundrel ") + " blockhead" for t in clean[:100]]
    model = toxicity.fit(toxic + clean[100:], np.array([1] * 100 + [0] * 100), 0.5)
    probes = pa.array([" ".join(prose(77)) + " blockheads", " ".join(prose(78))], pa.large_string())
    high, low = toxicity.likeliest_windows(probes, model.weights, model.bias)
    assert high > low


def test_scores_of_odd_tables(docs, spark):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(9)], "doc_id long, quality int, toxic int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for module, digest in ((toxicity, toxicity.toxicity_digest), (quality_model, quality_model.quality_model_digest)):
        for known in (labels, none):
            scores = [r["score"] for r in digest(docs, known).collect()]
            assert len(scores) == docs.count() and all(0 <= s <= 1 for s in scores)
        assert digest(docs.limit(0), none).collect() == []


def test_classifiers_held_out(spark):
    """Held-out accuracy on the small documents, above the larger class's share."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    for digest, label, least in (
        (toxicity.toxicity_digest, "toxic", 0.92), (quality_model.quality_model_digest, "quality", 0.95)
    ):
        judged = digest(docs, labels).join(labels, "doc_id").filter("held_out").select("predicted", label).collect()
        assert sum(r["predicted"] == r[label] for r in judged) / len(judged) >= least
