"""Running totals over sorted rows of any number, without a window that spans all of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bankflow.plans.workspace import materialize


def running_totals(
    df: DataFrame, value: str, order: Sequence[str], groups: Sequence[str] = (), into: str = "before"
) -> DataFrame:
    """Adds ``into``: the sum of ``value`` over the rows that come earlier in ``order`` within the row's group.

    Rows are range partitioned by group and order and written with the number of their partition; totals of partitions
    (one row for each partition and group in it) give what lies before a partition, and a window gives what lies before
    a row inside it. A group of any size is spread over partitions, so end ``order`` with a column that tells equal rows
    apart. Group columns must not be null. The result reads from the written table.
    """
    groups = list(groups)
    placed = materialize(
        df.repartitionByRange(*groups, *order).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    earlier = Window.orderBy("_range") if not groups else Window.partitionBy(*groups).orderBy("_range")
    rows_before = earlier.rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        placed.groupBy(*groups, "_range").agg(F.sum(value).alias("_total"))
        .select(*groups, "_range", F.coalesce(F.sum("_total").over(rows_before), F.lit(0)).alias("_earlier"))
    )
    inside = (
        Window.partitionBy(*groups, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        placed.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(totals, [*groups, "_range"])
        .withColumn(into, F.col("_earlier") + F.col("_inside"))
        .drop("_range", "_earlier", "_inside")
    )
