"""Personal data and secrets in texts, by regular expressions, checksums and context words; DataFrame functions only.

Regular expressions propose spans. Checksum validators confirm them (Luhn for cards, mod 97 for IBANs), words near a span,
before or after it, adjust its score, and a span is reported when its score reaches ``MIN_SCORE``. Kinds whose form alone
is proof (``BASE_KINDS``) start at that score, so context can only raise them; the added kinds need their checksum or a
context word. A secret is a long random word of letters and digits beside a word such as token or password.

Patterns are written so that a scan takes time in proportion to the text: runs are taken possessively and only from
their first character (or where the previous match ended), which finds the same leftmost matches without retrying every
suffix of a long run, and without recursion on long ones. Positions are summed up in chunks of matches, so a text with very
many of them takes time in proportion too.

Defined results: a null text counts as empty and has no spans; texts of any length are scanned whole; every row gets one
result, repeated rows too; an empty table gives an empty table; columns of the input are kept, and a column named like
the output column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "national_id", "local_phone", "secret")

MIN_SCORE = 0.5
CONTEXT_SCORE = 0.3
CONTEXT_CHARS = 48
# Matches whose positions are summed up at once.
_CHUNK = 256

_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
    "national_id": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "local_phone": r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9A-Za-z-])",
    "secret": r"(?<![A-Za-z0-9+/_.@-])[A-Za-z0-9+/_-]{20,}+={0,2}(?![A-Za-z0-9@.]\S)",
}

# A text without such characters has no match, and the scan is left out.
_NEEDS = {
    "email": lambda text: F.contains(text, F.lit("@")),
    "ip": lambda text: text.rlike(r"[0-9]\.[0-9]"),
    "card": lambda text: text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"),
    "phone": lambda text: F.contains(text, F.lit("+")),
    "iban": lambda text: text.rlike(r"[A-Z]{2}[0-9]{2}"),
    "national_id": lambda text: text.rlike(r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
    "local_phone": lambda text: text.rlike(r"[0-9]{3}[.-][0-9]{4}"),
    "secret": lambda text: text.rlike(_CONTEXT["secret"]),
}

# Score of the form alone, before checksum and context.
_FORM = {"email": 0.6, "ip": 0.5, "card": 0.5, "phone": 0.6, "iban": 0.8, "national_id": 0.3, "local_phone": 0.3,
         "secret": 0.3}

_CONTEXT = {
    "email": r"(?i)\b(e-?mail|contact|write to)\b",
    "ip": r"(?i)\b(ip|address|host|server|login)\b",
    "card": r"(?i)\b(card|credit|debit|visa|payment)\b",
    "phone": r"(?i)\b(phone|tel|call|mobile|fax)\b",
    "iban": r"(?i)\b(iban|account|bank|transfer)\b",
    "national_id": r"(?i)\b(ssn|social security|national id|id number)\b",
    "local_phone": r"(?i)\b(phone|tel|call|mobile|fax)\b",
    "secret": r"(?i)(token|secret|passw(?:or)?d|passphrase|credential|bearer|api[_\x20-]?key|access[_\x20-]?key|private[_\x20-]?key)",
}

_SPAN = "array<struct<kind:string,start:int,end:int,score:double>>"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _mod97(match: Column) -> Column:
    """The IBAN check: the first four characters go to the end, letters count 10 to 35, and the remainder is 1."""
    compact = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(compact, 5, 64), F.substring(compact, 1, 4))

    def step(rest: Column, char: Column) -> Column:
        code = F.ascii(char)
        value = F.when(code >= 65, code - 55).otherwise(code - 48)
        return F.pmod(rest * F.when(value > 9, 100).otherwise(10) + value, F.lit(97))

    return F.aggregate(F.split(turned, "(?<=.)(?=.)"), F.lit(0), step) == 1


def _confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?:\.|$)){4}$")
    if kind == "card":
        digits = _digits(match)
        return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    if kind == "iban":
        return _mod97(match)
    if kind == "national_id":
        return ~match.rlike(r"^(000|666|9)|-00-|-0000$")
    if kind == "secret":
        return match.rlike("[0-9]") & match.rlike("[A-Za-z]")
    return F.lit(True)


def _placed(pieces: Column) -> Column:
    """Reported spans with their positions, from the lengths of each match and of the gap before it, in order.

    An array grows by copying, so positions are first summed up within chunks of matches and then over the chunks.
    """
    none = F.array().cast("array<struct<start:int,size:int,score:double>>")

    def within(chunk: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            start = acc["at"] + x["gap"]
            return F.struct(
                (start + x["size"]).alias("at"),
                F.when(x["score"] >= MIN_SCORE, F.array_append(acc["found"], F.struct(
                    start.alias("start"), x["size"].alias("size"), x["score"].alias("score"))))
                .otherwise(acc["found"]).alias("found"))

        return F.aggregate(chunk, F.struct(F.lit(0).alias("at"), none.alias("found")), step)

    def joined(acc: Column, chunk: Column) -> Column:
        moved = F.transform(chunk["found"], lambda s: F.struct(
            (s["start"] + acc["at"]).alias("start"), s["size"].alias("size"), s["score"].alias("score")))
        return F.struct((acc["at"] + chunk["at"]).alias("at"), F.concat(acc["found"], moved).alias("found"))

    heads = F.when(F.size(pieces) > 0, F.sequence(F.lit(1), F.size(pieces), F.lit(_CHUNK)))
    chunks = F.transform(F.coalesce(heads, F.array().cast("array<int>")), lambda at: within(F.slice(pieces, at, _CHUNK)))
    return F.aggregate(
        chunks, F.struct(F.lit(0).alias("at"), none.alias("found")), joined, lambda acc: acc["found"])


def _spans(text: Column, kind: str) -> Column:
    """Spans of one kind, in order. The gaps between the matches and the matches themselves give the positions."""
    def of(parts: Column) -> Column:
        gaps, hits = parts["gaps"], parts["hits"]

        def piece(hit: Column, i: Column) -> Column:
            gap = F.get(gaps, i)
            # What stands before a match goes back over the match before it, but not over two.
            earlier = F.when(i > 0, F.concat(F.right(F.get(gaps, i - 1), F.lit(CONTEXT_CHARS)), F.get(hits, i - 1)))
            before = F.right(F.concat(F.coalesce(earlier, F.lit("")), gap), F.lit(CONTEXT_CHARS))
            near = F.concat_ws("\n", before, F.left(F.get(gaps, i + 1), F.lit(CONTEXT_CHARS)))
            score = F.least(F.lit(_FORM[kind]) + F.when(near.rlike(_CONTEXT[kind]), CONTEXT_SCORE).otherwise(0.0), F.lit(1.0))
            return F.struct(
                F.length(gap).alias("gap"), F.length(hit).alias("size"),
                F.when(F.coalesce(_confirmed(kind, hit), F.lit(False)), score).alias("score"))

        return F.transform(_placed(F.transform(hits, piece)), lambda s: F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), (s["start"] + s["size"]).alias("end"),
            s["score"].alias("score")))

    parts = F.struct(
        F.split(text, PATTERNS[kind], -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0)).alias("hits"))
    found = F.get(F.transform(F.array(parts), of), F.lit(0))
    return F.when(_NEEDS[kind](text), found).otherwise(F.array().cast(_SPAN)).cast(_SPAN)


def find_pii(docs: DataFrame, text: str = "text", into: str = "spans") -> DataFrame:
    """Adds the spans of every text: kind, start and end in code points (end exclusive), and score.

    Spans are ordered by kind as listed, then by start. One projection over the scan: no shuffle.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumn(into, F.concat(*(_spans(whole, kind) for kind in (*BASE_KINDS, *ADDED_KINDS))))


def redact(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """Replaces found spans by ``[kind]``; where spans overlap, the earlier and then the longer one counts."""
    ordered = F.array_sort(
        F.transform(F.col(spans), lambda s: F.struct(s["start"], (-s["end"]).alias("back"), s["kind"]))
    )
    whole = F.coalesce(F.col(text), F.lit(""))
    done = F.aggregate(
        ordered, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.when(
            s["start"] >= acc["at"],
            F.struct((-s["back"]).alias("at"), F.concat(
                acc["out"], F.substring(whole, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), s["kind"], F.lit("]"),
            ).alias("out")),
        ).otherwise(acc),
        lambda acc: F.concat(acc["out"], F.substring(whole, acc["at"] + 1, F.length(whole))),
    )
    return docs.withColumn(text, F.when(F.col(text).isNotNull(), done))


def pii_digest(docs: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, a hash of the base spans, all spans as text, and the counts of secrets and
    of all spans."""
    found = find_pii(docs.select("doc_id", "text"), "text", "spans")

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc_id", *(count(kind) for kind in BASE_KINDS), F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"), count("secret"), F.size("spans").cast("long").alias("n_spans"),
    )
