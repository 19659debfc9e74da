"""Range-partitioned JDBC reads.

``connection`` is a plain dict of JDBC options (url, user, password, driver, fetchsize ...) handed over by the caller.
"""

from __future__ import annotations

import datetime as dt
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def scan_query(table: str, alias: str = "src", where: str = "") -> str:
    """A table as the ``dbtable`` subquery of a scan, full or with a condition that the database evaluates."""
    return f"(select * from {table}{where}) {alias}"


def _literal(value: Any) -> str:
    """A mark as SQL text. Only dates and integers are accepted, so no text from outside gets into a query."""
    if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        return f"date '{value.isoformat()}'"
    if isinstance(value, int) and not isinstance(value, bool):
        return str(value)
    raise TypeError(f"a mark must be a date or an integer, not {type(value).__name__}")


def increment_condition(day: str | None, after: Any, with_nulls: bool = False) -> str:
    """Where clause of the rows after a mark, empty without one.

    ``day`` is a column or an expression of the source's dialect, so that dates kept as text are compared as dates where
    they are stored. ``with_nulls`` adds the rows without a date, which no mark ever passes.
    """
    if after is None:
        return ""
    newer = f"{day} > {_literal(after)}"
    return f" where ({newer} or {day} is null)" if with_nulls else f" where {newer}"


def bounds_query(
    table: str, column: str, date_column: str | None = None, after: Any = None, alias: str = "bounds",
    with_nulls: bool = False,
) -> str:
    """Minimum and maximum of the rows to read, computed in the database over an indexed key.

    Bounds of the whole table would put an increment, which holds the newest keys, into the last stride.
    """
    where = increment_condition(date_column, after, with_nulls)
    return f"(select min({column}) as lower_bound, max({column}) as upper_bound from {table}{where}) {alias}"


def probe_bounds(
    spark: SparkSession, connection: dict[str, str], table: str, column: str, date_column: str | None = None,
    after: Any = None, with_nulls: bool = False,
) -> tuple[Any, Any] | None:
    """(min, max) of ``column``; None only if there are no rows. Zero is a valid bound."""
    query = bounds_query(table, column, date_column, after, with_nulls=with_nulls)
    row = spark.read.format("jdbc").options(**connection).option("dbtable", query).load().first()
    return None if row is None or row[0] is None else (row[0], row[1])


def partition_options(column: str, bounds: tuple[Any, Any] | None, num_partitions: int) -> dict[str, str]:
    """Options of a parallel range scan. Bounds only set the strides; rows outside them are still read."""
    if bounds is None or num_partitions <= 1:
        return {}
    return {
        "partitionColumn": column,
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(num_partitions),
    }


def read_partitioned(
    spark: SparkSession,
    connection: dict[str, str],
    table: str,
    column: str,
    num_partitions: int,
    day: str | None = None,
    after: Any = None,
    with_nulls: bool = False,
) -> DataFrame:
    """Parallel scan of ``table``; with ``after``, only rows whose ``day`` (see ``increment_condition``) is greater. The
    database filters, in the scan and in the query for the bounds."""
    bounds = probe_bounds(spark, connection, table, column, day, after, with_nulls)
    query = scan_query(table, where=increment_condition(day, after, with_nulls))
    return (
        spark.read.format("jdbc").options(**connection).option("dbtable", query)
        .options(**partition_options(column, bounds, num_partitions)).load()
    )
