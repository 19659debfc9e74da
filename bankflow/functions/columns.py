"""Column expressions shared by the operators. All of them stay inside whole-stage codegen; there is no UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Floating-point addition depends on row order, so a double sum changes with the file splits and with every task retry.
# Sums go through a decimal and come back as double: the same answer for any partitioning.
EXACT = "decimal(28,10)"
# A value that is multiplied by a row count first: decimal(24,10) * decimal(13,0) is decimal(38,10), without rounding.
EXACT_PER_ROW = "decimal(24,10)"
EXACT_FACTOR = "decimal(13,0)"

DAY_FORMAT = "dd-MM-yyyy"


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL for a zero divisor (plain ``/`` raises in ANSI mode)."""
    return F.try_divide(numerator, denominator)


def percent(numerator: Column, denominator: Column) -> Column:
    return ratio(numerator, denominator) * F.lit(100)


def exact_sum(value: Column) -> Column:
    return F.sum(value.cast(EXACT)).cast("double")


def exact_avg(value: Column) -> Column:
    return F.try_divide(exact_sum(value), F.count(value))


def to_int64(value: Column) -> Column:
    """Double to integer with halves away from zero; a bare cast would truncate."""
    return F.round(value).cast("long")


def parse_day(text: Column, on_bad: str = "fail") -> Column:
    """``dd-MM-yyyy`` text to a date. ``on_bad='null'`` keeps a load alive on malformed rows."""
    if on_bad == "null":
        return F.try_to_timestamp(text, F.lit(DAY_FORMAT)).cast("date")
    return F.to_date(text, DAY_FORMAT)


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def day_gap(first: Column, second: Column) -> Column:
    """Days from ``second`` to ``first``."""
    return F.datediff(first, second).cast("long")


def event_weekday(event_ts: Column) -> Column:
    """Weekday of a ``dd-MM-yyyy HH:mm`` text, Sunday = 1."""
    return F.dayofweek(parse_day(F.substring(event_ts, 1, 10))).cast("long")


def event_hour(event_ts: Column) -> Column:
    return F.substring(event_ts, 12, 2).cast("long")


def id_prefix(identifier: Column) -> Column:
    return F.substring(identifier.cast("string"), 1, 3)
