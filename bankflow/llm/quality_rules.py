"""Document quality by rules, line first; DataFrame functions only.

Every line is judged on its own. Punctuation: a line of several words must close with a mark, and symbols must not take
its place. Navigation: bars of links, and rows of capitalised words without a closing mark. Boilerplate: stock phrases that
make up a short line or a good part of a long one; shouting. Lines that fail are removed, and a document that loses too
much of its text, or that repeats itself, is rejected. Base figures of the whole text are given beside the verdict.

Defined results: a null text counts as empty, has no words and is rejected; texts are read whole; every row gets one
result, repeated rows too; an empty table gives an empty table; other columns of the input are kept, and columns named
like the output are replaced. All of it is one projection over the scan: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Blank characters between words: space, and the controls 09 to 0D.
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
# A document is rejected when its failing lines hold more than this share of its word characters.
MAX_LOST_PERCENT = 50

# Line rules.
MAX_SYMBOL_PERCENT = 10
MIN_NAVIGATION_BARS = 3
MIN_SHOUTED_CHARS = 12
# Boilerplate in a line of this many characters or more has to make up this share of it.
LONG_LINE_CHARS = 120
MIN_BOILERPLATE_PERCENT = 20
# A closing mark and blanks at the end of a line; six words; four words or more, each with a capital.
CLOSED = r"[.!?:;,\x22\x27)\]…。”’»][\x20\x09-\x0D]*\z"
SEVERAL_WORDS = r"(?:[^\x20\x09-\x0D]+[\x20\x09-\x0D]+){5}[^\x20\x09-\x0D]"
CAPITALISED = r"^[\x20\x09-\x0D]*(?:\p{Lu}[^\x20\x09-\x0D]*[\x20\x09-\x0D]+){3,}\p{Lu}[^\x20\x09-\x0D]*[\x20\x09-\x0D]*\z"
BOILERPLATE = (
    r"(?i)\b(?:all rights reserved|cookie policy|we use cookies|privacy policy|terms of (use|service)|click here|"
    r"sign up|log ?in|subscribe|javascript (is|must be)|skip to (main )?content|back to top|share this|"
    r"lorem ipsum|read more$)"
)


_WORD = "[^\\x20\\x09-\\x0D]"
_SYMBOL = "[#*$%&|<>]"


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def words_of(text: Column) -> Column:
    """Words of a text, without empty pieces at its ends."""
    return F.when(text.rlike(_WORD), F.split(F.btrim(text, F.lit(BLANKS)), "[\\x20\\x09-\\x0D]+")).otherwise(
        F.array().cast("array<string>"))


def _word_chars(text: Column) -> Column:
    return F.length(_without(text, BLANKS)).cast("long")


def _symbols(text: Column) -> Column:
    """Most texts have no symbol, and a look for the first one is cheaper than a count."""
    counted = (F.length(text) - F.length(_without(text, SYMBOLS))).cast("long")
    return F.when(text.rlike(_SYMBOL), counted).otherwise(F.lit(0).cast("long"))


def line_fails(line: Column) -> Column:
    """Whether a line is removed: no closing mark, symbols instead of punctuation, navigation, shouting, or boilerplate."""
    chars = F.length(line)
    bars = chars - F.length(_without(line, "|"))
    shouted = (~line.rlike("[a-z]")) & (chars >= MIN_SHOUTED_CHARS) & (F.upper(line) == line) & (F.lower(line) != line)
    symbols = line.rlike(_SYMBOL) & (
        (_symbols(line) * 100 > chars * MAX_SYMBOL_PERCENT) | ((bars >= MIN_NAVIGATION_BARS) & (bars * 20 > chars)))
    # Most lines are closed, and nothing else is asked of them here.
    unclosed = ~line.rlike(CLOSED) & (line.rlike(SEVERAL_WORDS) | line.rlike(CAPITALISED))
    stock = chars - F.length(F.regexp_replace(line, BOILERPLATE, ""))
    boilerplate = line.rlike(BOILERPLATE) & (
        (chars < LONG_LINE_CHARS) | (stock * 100 >= chars * MIN_BOILERPLATE_PERCENT))
    return symbols | shouted | unclosed | boilerplate


def _repeat_words(words: Column) -> Column:
    """Words inside windows of ``WINDOW`` words that occur twice or more, overlapping ones counted once.

    Windows are compared by 64-bit hashes of their words' hashes. Only a text with equal windows is sorted.
    """

    def joined(parts: Column, apart: int) -> Column:
        """Hashes of twice as many words: each with the one ``apart`` places on."""
        n = F.size(parts) - apart
        return F.zip_with(F.slice(parts, 1, n), F.slice(parts, apart + 1, n), lambda x, y: F.xxhash64(x, y))

    def covered(marks: Column) -> Column:
        ordered = F.array_sort(F.transform(marks, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        # A window is repeated if a neighbour in hash order is equal to it.
        repeated = F.array_sort(_in(ordered, lambda s: F.filter(
            F.transform(s, lambda x, k: F.when(
                (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]), x["i"])),
            lambda i: i.isNotNull(),
        )))
        return _in(repeated, lambda r: F.aggregate(
            F.transform(r, lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get(r, k + 1) - i, F.lit(WINDOW)))),
            F.lit(0), lambda total, n: total + n,
        ))

    def counted(marks: Column) -> Column:
        return F.when(F.size(F.array_distinct(marks)) < F.size(marks), covered(marks)).otherwise(0)

    return F.when(
        F.size(words) > WINDOW,
        _in(joined(words, 1), lambda two: _in(joined(two, 2), lambda four: _in(joined(four, 4), counted))),
    ).otherwise(0).cast("long")


def _in(value: Column, body) -> Column:
    """``body`` over a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def quality_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, lost_chars, n_lost_lines,
    clean_text`` and ``kept``; ``clean_text`` is the text without the failing lines."""
    whole = F.coalesce(F.col(text), F.lit(""))
    read = (
        docs.withColumn("_words", words_of(whole))
        .withColumn("_lines", F.transform(F.split(whole, "\n"), lambda line: F.struct(
            line.alias("line"), F.coalesce(line_fails(line), F.lit(False)).alias("fails"))))
    )
    worded = F.filter(F.col("_lines.line"), lambda line: line.rlike(_WORD))
    failing = F.filter("_lines", lambda x: x["fails"])
    figures = (
        read.withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long"))
        .withColumn("n_symbols", _symbols(whole))
        .withColumn("n_dup_lines", _in(worded, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"))
        .withColumn("n_repeat_words", _repeat_words(F.col("_words")))
        .withColumn("lost_chars", F.aggregate(
            failing, F.lit(0).cast("long"), lambda total, x: total + _word_chars(x["line"])))
        .withColumn("n_lost_lines", F.size(failing).cast("long"))
        .withColumn("clean_text", F.when(F.col(text).isNotNull(), F.array_join(F.transform(
            F.filter("_lines", lambda x: ~x["fails"]), lambda x: x["line"]), "\n")))
    )
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (
        figures.withColumn("base_failed", base_failed)
        .withColumn("kept", ~F.col("base_failed") & (
            F.col("lost_chars") * 100 <= F.col("word_chars") * MAX_LOST_PERCENT))
        .drop("_words", "_lines")
    )


def quality_digest(docs: DataFrame) -> DataFrame:
    """Per document: base figures, base verdict, what the line rules removed, and the verdict."""
    judged = quality_rules(docs.select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lost_lines", "lost_chars",
    )
