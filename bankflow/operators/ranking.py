"""Ranks within groups that may be far larger than one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bankflow.plans import materialize


def top_in_group(df: DataFrame, group: str, value: str) -> DataFrame:
    """Rows with the greatest ``value`` of their group, ties kept: rank() = 1 in descending order.

    The greatest values are aggregated before the shuffle and joined back. A window would bring each group, and all of
    its ties, into one task. Comparison is null-safe: NULL is a group, and a group of NULL values is one tie.
    """
    best = materialize(df.groupBy(group).agg(F.max(value).alias("_best")), "best").withColumnRenamed(group, "_group")
    return df.join(best, F.col(group).eqNullSafe(F.col("_group")) & F.col(value).eqNullSafe(F.col("_best")), "left_semi")


def rank_in_group(df: DataFrame, group: str, value: str, ranges: int | None = None) -> DataFrame:
    """``rank()`` per group by descending ``value``, NULL values last.

    The distinct values of all groups are counted and cut into ranges by group and value (``ranges`` of them, or as many as
    adaptive execution finds fit); a rank is the number of rows of the group in the ranges before, plus those before it in
    its own range. So a group of any size is spread over ranges, and rows only travel to find their rank.
    """
    order = [F.col(group), F.col(value).desc()]
    counted = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("_rows"))
    # The range number is written with the row, so both uses below see the same cut.
    counted = materialize(
        counted.repartitionByRange(*([ranges] if ranges else []), *order).withColumn("_range", F.spark_partition_id()),
        "ranged_values")

    # A group has at most one row per range here, and a range holds what fits one task.
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.groupBy(group, "_range").agg(F.sum("_rows").alias("_rows"))
    offsets = offsets.select(
        F.col(group).alias("_g"), F.col("_range").alias("_r"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
    )
    inside = (
        Window.partitionBy(group, "_range").orderBy(F.col(value).desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranks = (
        counted.withColumn("_inside", F.coalesce(F.sum("_rows").over(inside), F.lit(0)))
        .join(offsets, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_range") == F.col("_r")))
        .select(
            F.col(group).alias("_group"), F.col(value).alias("_value"),
            (F.col("_before") + F.col("_inside") + 1).alias("rank"),
        )
    )
    return df.join(
        ranks, F.col(group).eqNullSafe(F.col("_group")) & F.col(value).eqNullSafe(F.col("_value"))
    ).drop("_group", "_value")
