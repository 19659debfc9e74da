"""Rows of one payment in different clearing systems, compared pairwise."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankflow.functions import day_gap, percent
from bankflow.plans import DEFAULT_CHUNK, materialize, may_be_crowded
from bankflow.schemas import RECONCILIATION_REPORT, conform

MAX_DIFFERENCE_PERCENT = 1
MAX_DIFFERENCE_DAYS = 2

_COLUMNS = ["PaymentID", "ClearingSystem", "Amount", "PaymentDate"]


def _side(df: DataFrame, n: int) -> DataFrame:
    return df.select(
        "PaymentID", *[c for c in df.columns if c.startswith("_")],
        *[F.col(c).alias(f"{c}{n}") for c in _COLUMNS if c != "PaymentID"],
    )


def _cells(count: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), count - 1))


def _crowded_pairs(rows: DataFrame, crowded: DataFrame, side: int) -> DataFrame:
    """Pairs of the few payments that have very many rows, in cells of ``side`` by ``side`` rows.

    Joining on the payment alone would look at every pair of its rows, also where nearly all sit in one clearing system.
    So the pairs of systems come first, from counts, and each row is sent only to the cells where it has partners.
    """
    # The id is taken at the scan, where a lost task computes the same one again.
    hot = rows.withColumn("_id", F.monotonically_increasing_id()).join(crowded, "PaymentID", "left_semi")
    systems = (
        hot.filter(F.col("ClearingSystem").isNotNull()).groupBy("PaymentID", "ClearingSystem")
        .agg(F.ceil(F.count(F.lit(1)) / F.lit(side)).cast("int").alias("_k"))
    )
    systems = materialize(systems, "systems")
    pairs = (
        systems.select("PaymentID", F.col("ClearingSystem").alias("_cs1"), F.col("_k").alias("_k1"))
        .join(
            systems.select("PaymentID", F.col("ClearingSystem").alias("_cs2"), F.col("_k").alias("_k2")), "PaymentID"
        ).filter(F.col("_cs1") != F.col("_cs2"))
    )
    on = ["PaymentID", "_cs1", "_cs2", "_s1", "_s2"]
    left = (
        hot.join(pairs.withColumn("ClearingSystem", F.col("_cs1")), ["PaymentID", "ClearingSystem"])
        .withColumn("_s1", F.pmod("_id", F.col("_k1").cast("long")).cast("int"))
        .withColumn("_s2", _cells(F.col("_k2")))
    )
    right = (
        hot.join(pairs.withColumn("ClearingSystem", F.col("_cs2")), ["PaymentID", "ClearingSystem"])
        .withColumn("_s2", F.pmod("_id", F.col("_k2").cast("long")).cast("int"))
        .withColumn("_s1", _cells(F.col("_k1")))
    )
    drop = ["_id", "_k1", "_k2"]
    return _side(left.drop(*drop), 1).join(_side(right.drop(*drop), 2), on).drop(*on[1:])


def payment_reconciliation(payments: DataFrame, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """Every ordered pair of rows of a payment whose clearing systems differ, marked Matched or Mismatched.

    A payment whose rows could give more than ``chunk`` pairs is split into cells of that many.
    """
    rows, side = payments.select(*_COLUMNS), max(1, math.isqrt(chunk))
    # Any payment that the sample finds may take the longer way, which gives the same pairs.
    crowded = may_be_crowded({"rows": rows}, "PaymentID", side)
    usual = rows if crowded is None else rows.join(crowded, "PaymentID", "left_anti")
    pairs = _side(usual, 1).join(_side(usual, 2), "PaymentID").filter(
        F.col("ClearingSystem1") != F.col("ClearingSystem2")
    )
    if crowded is not None:
        pairs = pairs.unionByName(_crowded_pairs(rows, crowded, side))

    compared = pairs.select(
        "PaymentID", "ClearingSystem1", "ClearingSystem2",
        percent(F.abs(F.col("Amount1") - F.col("Amount2")), F.col("Amount1")).alias("AmountDifferencePercent"),
        F.abs(day_gap(F.col("PaymentDate1"), F.col("PaymentDate2"))).alias("DateDifferenceDays"),
    )
    differs = (F.col("AmountDifferencePercent") > MAX_DIFFERENCE_PERCENT) | (
        F.col("DateDifferenceDays") > MAX_DIFFERENCE_DAYS
    )
    return conform(
        compared.withColumn("Status", F.when(differs, "Mismatched").otherwise("Matched")), RECONCILIATION_REPORT
    )
