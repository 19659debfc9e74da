"""Groups of rows that are linked, from candidate buckets, without making the pairs of a bucket.

A bucket holds rows that may be alike. In each round a few rows of every bucket are its centres; only pairs of a centre
and a row of another group are verified, links join groups, and the centres leave the bucket with all their pairs done. A
bucket whose rows are in one group by then is done: further links in it would change nothing. A bucket of copies takes
one round and as many pairs as it has rows. No pair that could join two groups is left out, whatever the bucket's size.

Rows of a bucket that are no links would all be tried in the end. Where their sets are known, buckets by shared shingles
are no good: ``rare_keys`` makes buckets by the rarest shingles of each set instead, and gives the condition that the
places of a shared shingle put on a pair. Sets that cannot be links then hardly meet.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankflow.plans.workspace import materialize

# By how much the number of centres in a bucket grows from round to round.
GROWTH = 8


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b``, longs): root is the smallest node that can be reached.

    Alternates large-star and small-star steps over joins with partial aggregates; every step is written.
    """
    current = materialize(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(),
        "edges",
    )
    state = None
    while True:
        found = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first()
        if found == state or found[0] == 0:
            break
        state = found
        both = current.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
            current.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = (
            both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        )
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").select(F.explode(F.array(
            F.struct("hi", F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")),
        )).alias("e")).select("e.hi", "e.lo").filter("hi <> lo").distinct()
        current = materialize(small, "edges")
    return current.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionAll(
        current.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())


def shared_buckets(members: DataFrame) -> DataFrame:
    """Rows of ``members`` (``key, id``) whose bucket has two ids or more."""
    several = materialize(
        members.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most"))
        .filter("least <> most").select("key"), "shared_keys",
    )
    return members.join(several, "key", "left_semi")


def rare_keys(sets: DataFrame, percent: int) -> DataFrame:
    """Buckets of sets (``id, shingles``, written) such that any two with a similarity of ``percent`` or more share one.

    All sets put their shingles in one order, rarest first. Two sets with so many in common share one of the first
    n - ceil(n * percent / 100) + 1 of each. A row is ``key, id, place, size, alone``: the shingle, its place from 1, the
    size of the set, and how many of its shingles no other set has. Those come first and are no keys; a set whose first
    ones are all its own has no links and no rows.
    """
    members = sets.select("id", F.size("shingles").cast("long").alias("size"), F.explode("shingles").alias("shingle"))
    known = materialize(
        members.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "known_shingles")
    first = (F.col("size") - F.ceil(F.col("size") * percent / 100) + 1 - F.col("alone")).cast("int")
    keys = materialize(
        members.join(known, "shingle").groupBy("id", "size")
        .agg(F.array_sort(F.collect_list(F.struct("n", "shingle"))).alias("shared"))
        .withColumn("alone", F.col("size") - F.size("shared")).filter(first > 0)
        .select("id", "size", "alone", F.posexplode(F.slice("shared", 1, first)).alias("at", "member"))
        .select(F.col("member.shingle").alias("key"), "id", (F.col("alone") + F.col("at") + 1).alias("place"), "size",
                "alone"), "rare_keys")
    # What the smallest set of a bucket still allows a row at its place.
    least = keys.groupBy("key").agg(F.min("size").alias("least"))
    smallest = F.greatest(F.col("least") * 100, F.col("size") * percent)
    possible = keys.join(least, "key").filter(
        (1 + F.col("size") - F.col("place")) * (100 + percent) * 100 >= (F.col("size") * 100 + smallest) * percent)
    return shared_buckets(materialize(possible.drop("least"), "possible_keys"))


def may_link(percent: int) -> Callable[[DataFrame, DataFrame], Column]:
    """The most that two sets can have in common, by the places of a shared shingle, is enough. Without the shared
    shingles before these places, which only raise it: some other bucket has the first one."""
    def condition(a: DataFrame, b: DataFrame) -> Column:
        after = F.least(a["size"] - a["place"], b["size"] - b["place"])
        sizes = F.least(a["size"], b["size"]) * 100 >= F.greatest(a["size"], b["size"]) * percent
        return sizes & ((1 + after) * (100 + percent) >= (a["size"] + b["size"]) * percent)

    return condition


def link_groups(
    buckets: DataFrame, verify: Callable[[DataFrame], DataFrame],
    meets: Callable[[DataFrame, DataFrame], Column] | None = None, first_by: str | None = None,
) -> DataFrame:
    """``node, root`` for every row of ``buckets`` (``key, id``, written) that has a link.

    ``verify`` takes pairs ``a, b`` with a below b and returns those that are links; ``meets`` is what a row and a centre
    of one bucket must fulfil to be a pair. The first centre of a bucket is the least by ``first_by``. The number of
    centres grows from round to round, so a bucket whose rows are all apart ends after a logarithmic number of rounds.
    """
    pool = buckets.withColumn("root", F.col("id"))
    roots = buckets.sparkSession.createDataFrame([], "node long, root long")
    number = 0
    while not pool.isEmpty():
        turn = F.xxhash64("id", F.lit(number))
        order = turn if first_by is None else F.struct(F.col(first_by), turn)
        sizes = pool.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min_by("id", order).alias("first"))
        every = F.greatest(F.lit(1).cast("long"), F.floor(F.col("n") / F.lit(GROWTH**number)))
        centres = materialize(
            pool.join(sizes, "key").filter((F.col("id") == F.col("first")) | (
                (F.lit(number) > 0) & (F.pmod(turn, every) == 0)))
            .drop("n", "first").withColumnsRenamed({"id": "centre", "root": "centre_root"}), "centres",
        )
        condition = (pool["key"] == centres["key"]) & (pool["root"] != centres["centre_root"])
        if meets is not None:
            condition &= meets(pool, centres)
        pairs = materialize(
            pool.join(centres, condition)
            .select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct(), "pairs")
        links = materialize(verify(pairs), "links")
        if not links.isEmpty():
            known = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
            roots = materialize(components(links.unionAll(known)), "roots")
        rest = (
            pool.drop("root")
            .join(centres.select("key", F.col("centre").alias("id")), ["key", "id"], "left_anti")
            .join(roots.withColumnRenamed("node", "id"), "id", "left")
            .select(*buckets.columns, F.coalesce("root", "id").alias("root"))
        )
        open_keys = (
            rest.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most"))
            .filter("least <> most").select("key")
        )
        pool = materialize(rest.join(open_keys, "key", "left_semi"), "pool")
        number += 1
    return roots
