"""Mixes of sources by target weights, as weighted fair queueing; DataFrame functions only.

Each source has a target: its weighted share of a budget, at most ``MAX_PASSES`` times its own size, and what it cannot
use goes to the others by weight. Its documents stand in a shuffled order and come round once per pass; a document's
virtual finish time is the number of words that its source has sent by then, divided by the source's target. All
documents are sorted by finish time over range partitions and the queue is cut where the budget is full.

Every source has sent about its target when the queue is cut: it is off by one document at most, and a source whose
target is ``MAX_PASSES`` times its size is taken whole that often.

Defined results: a null text has no words; documents without words are never taken (0 words); the null source is a
source, after all others; equal rows are documents of their own and may differ in what is taken of them, but the rows
that come out are the same on every run; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bankflow.llm.ranges import running_totals
from bankflow.plans.workspace import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_PASSES = 2
_SEED = 29


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """``source, n, source_size, target, budget``: one row per source of ``sizes`` (columns ``source, size``).

    Sources take the weights in turn, by code point, null last. Targets come from one level for all: a source gets level
    times weight, or its cap where that is less. With sources sorted by cap over weight, the level is the largest of
    what remains per remaining weight when the sources before are at their caps. The windows run over the table of
    sources, not over documents.
    """
    in_turn = F.array(*(F.lit(float(w)) for w in weights))
    named = (
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("n", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
        .withColumn("weight", F.get(in_turn, F.pmod(F.col("n") - 1, F.lit(len(weights)))))
        .withColumn("cap", F.lit(float(MAX_PASSES)) * F.col("source_size"))
    )
    everyone = Window.partitionBy(F.lit(1))
    by_ratio = everyone.orderBy(F.col("cap") / F.col("weight"), "n")
    return (
        named.withColumn("budget", F.sum("source_size").over(everyone) * share)
        .withColumn("_capped", F.coalesce(
            F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("_weights", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("_level", F.max((F.col("budget") - F.col("_capped")) / F.col("_weights")).over(everyone))
        .withColumn("target", F.least(F.col("_level") * F.col("weight"), F.col("cap")))
        .select("source", "n", "source_size", "target", "budget")
    )


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, key: Sequence[str] = ()) -> DataFrame:
    """One row per document with ``doc_id, source, size, source_size, target, copies, taken``.

    ``copies`` is how often the document is taken, ``taken`` its words times that. ``key`` names further columns of
    ``docs`` to keep, to join the result back.
    """
    base = materialize(
        docs.select("doc_id", "source", *key, word_count(F.col("text")).alias("size"))
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("_shuffled", F.xxhash64(F.lit(_SEED), "doc_id", "size")), "mix_base",
    )
    targets = materialize(source_targets(base, weights, share), "mix_targets")
    joined = base.join(targets, base["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    queued = running_totals(
        joined.filter("size > 0").select("row", "doc_id", "n", "size", "source_size", "target", "budget", "_shuffled"),
        "size", ["_shuffled", "doc_id", "size", "row"], ["n"], "_sent",
    )
    entries = queued.withColumn("_pass", F.explode(F.array(*map(F.lit, range(MAX_PASSES))))).withColumn(
        "_finish", (F.col("_pass") * F.col("source_size") + F.col("_sent") + F.col("size")) / F.col("target"))
    cut = running_totals(
        entries, "size", ["_finish", "n", "_pass", "_shuffled", "doc_id", "size", "row"], into="_before"
    ).filter(F.col("_before") + F.col("size") <= F.col("budget"))
    copies = cut.groupBy("row").agg(F.count(F.lit(1)).alias("copies"))
    return (
        joined.join(copies, "row", "left")
        .withColumn("copies", F.coalesce("copies", F.lit(0)))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .select("doc_id", "source", *key, "size", "source_size", "target", "copies", "taken")
    )


def mix_digest(docs: DataFrame) -> DataFrame:
    """Per document: its words, its source's words and target, and the words that the mix takes of it."""
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")
