"""DuckDB SQL of the corpus queries that SQL can express, by definition: all pairs that share a shingle, all windows.

The other queries rest on tokenizer ranks, sketches or trained models, which SQL lacks; tests compare them with brute force.
"""

from __future__ import annotations

from bankflow.llm.quality_rules import (
    BOILERPLATE, CAPITALISED, CLOSED, LONG_LINE_CHARS, MAX_LOST_PERCENT, MAX_REPEAT_PERCENT, MAX_SYMBOL_PERCENT,
    MIN_BOILERPLATE_PERCENT, MIN_NAVIGATION_BARS, MIN_SHOUTED_CHARS, MIN_WORDS, SEVERAL_WORDS, WINDOW,
)

_BLANK = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]"
_SYMBOL = "[#*$%&|<>]"


def _without(text: str, pattern: str) -> str:
    return f"regexp_replace({text}, '{pattern}', '', 'g')"


NEAR_DUPLICATES = f"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}+') AS words
    FROM documents
), sets AS (
    SELECT doc_id, list_distinct(CASE WHEN len(words) = 1 THEN words
        ELSE [words[i] || ' ' || words[i + 1] for i in range(1, len(words))] END) AS shingles
    FROM worded
), sized AS (
    SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles FROM sets
), members AS (
    SELECT s.doc_id, n_shingles, unnest(shingles) AS shingle FROM sets s JOIN sized USING (doc_id)
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM members a JOIN members b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
    WHERE 100 * least(a.n_shingles, b.n_shingles) >= 80 * greatest(a.n_shingles, b.n_shingles)
    GROUP BY a.doc_id, b.doc_id, a.n_shingles, b.n_shingles
    HAVING 100 * count(*) >= 80 * (a.n_shingles + b.n_shingles - count(*))
), reach AS (
    SELECT doc_id AS node, doc_id AS other FROM sized
    UNION
    SELECT r.node, e.b FROM reach r JOIN (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) e ON r.other = e.a
)
SELECT doc_id, n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM sized JOIN reach ON node = doc_id
GROUP BY doc_id, n_shingles
"""

QUALITY_RULES = f"""
WITH whole AS (
    SELECT doc_id, coalesce(text, '') AS text FROM documents
), worded AS (
    SELECT *, regexp_extract_all(text, '{_WORD}+') AS words FROM whole
), places AS (
    SELECT doc_id, words, unnest(range(1, len(words) - {WINDOW} + 2)) AS place FROM worded
), windows AS (
    SELECT doc_id, place, list_slice(words, place, place + {WINDOW} - 1) AS piece FROM places
), repeats AS (
    SELECT doc_id, unnest(list(place)) AS place FROM windows GROUP BY doc_id, piece HAVING count(*) > 1
), repeated AS (
    SELECT doc_id, count(DISTINCT covered) AS n_repeat_words
    FROM (SELECT doc_id, unnest(range(place, place + {WINDOW})) AS covered FROM repeats) GROUP BY doc_id
), lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM whole
), measured AS (
    SELECT *, length(line) AS chars, length(line) - length(replace(line, '|', '')) AS bars,
        length(line) - length({_without("line", _SYMBOL)}) AS symbols
    FROM lines
), failing AS (
    SELECT doc_id, count(*) AS n_lost_lines, sum(length({_without("line", _BLANK)})) AS lost_chars
    FROM measured
    WHERE symbols > 0 AND (symbols * 100 > chars * {MAX_SYMBOL_PERCENT}
            OR (bars >= {MIN_NAVIGATION_BARS} AND bars * 20 > chars))
        OR NOT regexp_matches(line, '[a-z]') AND chars >= {MIN_SHOUTED_CHARS}
            AND upper(line) = line AND lower(line) <> line
        OR NOT regexp_matches(line, '{CLOSED}')
            AND (regexp_matches(line, '{SEVERAL_WORDS}') OR regexp_matches(line, '{CAPITALISED}'))
        OR regexp_matches(line, '{BOILERPLATE}') AND (chars < {LONG_LINE_CHARS}
            OR (chars - length({_without("line", BOILERPLATE)})) * 100 >= chars * {MIN_BOILERPLATE_PERCENT})
    GROUP BY doc_id
), line_counts AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM lines WHERE regexp_matches(line, '{_WORD}') GROUP BY doc_id
), figures AS (
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
        CAST(length({_without("text", _BLANK)}) AS BIGINT) AS word_chars,
        CAST(length(text) - length({_without("text", _SYMBOL)}) AS BIGINT) AS n_symbols,
        CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
        CAST(coalesce(n_lost_lines, 0) AS BIGINT) AS n_lost_lines, CAST(coalesce(lost_chars, 0) AS BIGINT) AS lost_chars
    FROM worded LEFT JOIN repeated USING (doc_id) LEFT JOIN failing USING (doc_id) LEFT JOIN line_counts USING (doc_id)
), judged AS (
    SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM figures
)
SELECT *, NOT base_failed AND lost_chars * 100 <= word_chars * {MAX_LOST_PERCENT} AS kept FROM judged
"""

# Five hexadecimal digits are four letters of base 32.
WARC = """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS payload FROM pages
), grouped AS (
    SELECT page_id, payload, sha1(payload) AS hex, min(page_id) OVER (PARTITION BY payload) AS first FROM payloads
)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(range(32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        ((CAST('0x' || substr(hex, (j // 4) * 5 + 1, 5) AS BIGINT) >> (15 - 5 * (j % 4))) & 31) + 1, 1)), '')
        AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to
FROM grouped
"""


def _part(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || {column}, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_part, ("doc_id", "source", "lang", "n_chars", text))) + ")"


def _tree(name: str, lowest: str) -> str:
    """Nodes of all levels: every three neighbours of a group make one of the next level, while there are several."""
    return f"""{name} AS (
    SELECT grp, 0 AS level, pos, digest FROM {lowest}
    UNION ALL
    SELECT grp, level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos))
    FROM (SELECT *, count(*) OVER (PARTITION BY grp) AS n FROM {name}) WHERE n > 1 GROUP BY grp, level, pos // 3
)"""


_CRC = "CASE WHEN op >= 0 THEN xor(crc, op) WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END"

MANIFEST = f"""
WITH RECURSIVE checked AS (
    SELECT *, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
        string_split(CAST(doc_id AS VARCHAR), ''),
        lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))), lambda crc, op: {_CRC})) AS crc
    FROM documents
), leaves AS (
    SELECT row_number() OVER (ORDER BY coalesce('s' || source, ''), doc_id) AS k, doc_id, coalesce('s' || source, '') AS grp,
        row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos, {_leaf("text")} AS digest,
        CASE WHEN crc % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS present
    FROM checked
), {_tree("nodes", "leaves")}, heights AS (
    SELECT grp, max(level) AS height FROM nodes GROUP BY grp
), subroots AS (
    SELECT 'all' AS grp, row_number() OVER (ORDER BY n.grp) - 1 AS pos, n.digest, n.grp AS source_grp
    FROM nodes n JOIN heights h ON n.grp = h.grp AND n.level = h.height
), {_tree("upper", "subroots")}, root AS (
    SELECT digest AS root, level AS height FROM upper ORDER BY level DESC LIMIT 1
), places AS (
    SELECT l.k, l.grp, h.height, unnest(range(h.height)) AS level, l.pos AS leaf_pos
    FROM leaves l JOIN heights h USING (grp)
), lower_steps AS (
    SELECT p.k, p.level AS step, p.leaf_pos // CAST(pow(3, p.level) AS BIGINT) AS own, p.grp, p.level FROM places p
), upper_steps AS (
    SELECT l.k, 100 + u.level AS step, s.pos // CAST(pow(3, u.level) AS BIGINT) AS own, u.level
    FROM leaves l JOIN subroots s ON s.source_grp = l.grp
    JOIN (SELECT unnest(range((SELECT height FROM root))) AS level) u ON TRUE
), sides AS (
    SELECT p.k, p.step, string_agg(n.digest, '' ORDER BY n.pos) FILTER (n.pos < p.own) AS before,
        string_agg(n.digest, '' ORDER BY n.pos) FILTER (n.pos > p.own) AS after
    FROM lower_steps p JOIN nodes n ON n.grp = p.grp AND n.level = p.level AND n.pos // 3 = p.own // 3 GROUP BY p.k, p.step
    UNION ALL
    SELECT p.k, p.step, string_agg(n.digest, '' ORDER BY n.pos) FILTER (n.pos < p.own),
        string_agg(n.digest, '' ORDER BY n.pos) FILTER (n.pos > p.own)
    FROM upper_steps p JOIN upper n ON n.level = p.level AND n.pos // 3 = p.own // 3 GROUP BY p.k, p.step
), steps AS (
    SELECT k, row_number() OVER (PARTITION BY k ORDER BY step) AS number, coalesce(before, '') AS before,
        coalesce(after, '') AS after
    FROM sides
), folds AS (
    SELECT k, CAST(0 AS BIGINT) AS number, present AS digest FROM leaves
    UNION ALL
    SELECT f.k, s.number, sha256(s.before || f.digest || s.after)
    FROM folds f JOIN steps s ON s.k = f.k AND s.number = f.number + 1
), proofs AS (
    SELECT k, string_agg(before || after, '' ORDER BY number) AS proof FROM steps GROUP BY k
), ends AS (
    SELECT k, arg_max(digest, number) AS folded_root FROM folds GROUP BY k
)
SELECT l.doc_id, l.digest AS leaf, s.digest AS subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root,
    folded_root = root AS verified
FROM leaves l JOIN subroots s ON s.source_grp = l.grp JOIN ends USING (k) LEFT JOIN proofs USING (k) JOIN root ON TRUE
"""

HARD_NEGATIVES = """
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vector
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
        CAST(list_inner_product(a.vector, b.vector) AS BIGINT) AS score
    FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT * FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), mined AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score,
        n.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS rank
    FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
        AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM mined WHERE rank <= 10
"""

ORACLES: dict[str, str] = {
    "op7_near_duplicates": NEAR_DUPLICATES, "op9_quality_rules": QUALITY_RULES, "op11_warc": WARC,
    "op12_manifest": MANIFEST, "op13_hard_negatives": HARD_NEGATIVES,
}
