"""A row's neighbours in an order, without a task that holds all rows of a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bankflow.plans.workspace import materialize

_RANGE = "_range"


def in_ranges(df: DataFrame, key: str, order: str, ranges: int | None = None) -> DataFrame:
    """The rows in ranges of ``key, order``, with the number of their range, written. A key with very many rows spans
    several ranges; without ``ranges`` adaptive execution sizes them."""
    number = [] if ranges is None else [ranges]
    return materialize(
        df.repartitionByRange(*number, key, order).withColumn(_RANGE, F.spark_partition_id()), "ranges")


def _beside(placed: DataFrame, key: str, order: str, values: Sequence[str], into: str, before: bool) -> DataFrame:
    inside = Window.partitionBy(_RANGE, key).orderBy(order)
    step, pick = (F.lag, F.max_by) if before else (F.lead, F.min_by)
    value = F.struct(F.lit(True).alias("_there"), *values)
    # The last (first) row of every range: as many rows as there are ranges.
    edges = placed.groupBy(_RANGE).agg(pick(F.struct(key, value.alias("value")), F.struct(key, order)).alias("edge"))
    beside = edges.select(_RANGE, step("edge").over(Window.orderBy(_RANGE)).alias("_edge"))
    return (
        placed.withColumn("_inside", step(value).over(inside)).join(beside, _RANGE, "left")
        .withColumn(into, F.coalesce(
            F.col("_inside"), F.when(F.col("_edge")[key] == F.col(key), F.col("_edge")["value"])))
        .drop("_inside", "_edge")
    )


def with_previous(placed: DataFrame, key: str, order: str, values: Sequence[str], into: str) -> DataFrame:
    """Adds ``into``: a struct of ``values`` of the row before in the same key, or null. ``placed`` comes from
    ``in_ranges``; keys are not null, and ``order`` tells the rows of a key apart."""
    return _beside(placed, key, order, values, into, True)


def with_next(placed: DataFrame, key: str, order: str, values: Sequence[str], into: str) -> DataFrame:
    """Adds ``into``: a struct of ``values`` of the row after. Rows may have been left out since ``in_ranges``."""
    return _beside(placed, key, order, values, into, False)


def without_range(df: DataFrame) -> DataFrame:
    return df.drop(_RANGE)


def field(column: str, name: str) -> Column:
    return F.col(column)[name]
