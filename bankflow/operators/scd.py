"""Slowly changing dimensions as new snapshots.

A daily staging table is far smaller than its target. The changed snapshot is therefore built from joins whose preserved
side is the target: a small staging side is broadcast by the optimizer and the target is not shuffled; a large one is
sort-merged, and adaptive execution may split the target where a key is hot.

With ``kind`` a merge names in a column what it did with each row: kept, updated, inserted or closed. Tables that rewrite
only the touched buckets merge by ``plans/merges.py``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankflow.plans.ordered import field, in_ranges, with_next, with_previous, without_range
from bankflow.schemas import BRANCH, CUSTOMER, LOANS, conform

# The loan columns whose change starts a new version.
LOAN_TRACKED = (
    "LoanType", "PaymentFrequency", "InterestRate", "Amount", "EndDate", "Collateral", "Status",
)


def newest_per_key(staging: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """One row per key, the greatest by ``order_by``; remaining ties go by the other columns, so reruns agree.

    An aggregate, not row_number(): copies of one key are reduced before the shuffle. Rows without a key are no
    duplicates of each other and are all kept.
    """
    order = [*order_by, *[c for c in staging.columns if c not in order_by]]
    newest = (
        staging.filter(F.col(key).isNotNull()).groupBy(key)
        .agg(F.max(F.struct(*order)).alias("_row")).select(*[F.col(f"_row.{c}").alias(c) for c in staging.columns])
    )
    return newest.unionByName(staging.filter(F.col(key).isNull()))


def require_unique(staging: DataFrame, key: str) -> DataFrame:
    """Fail, as a warehouse merge does, when two staging rows claim one key."""
    repeated = staging.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1")
    example = repeated.select(key).first()
    if example is not None:
        raise ValueError(f"staging has more than one row for {key} = {example[0]}")
    return staging


def _changed(columns: Sequence[str], null_safe: bool = True) -> Column:
    """Any of ``columns`` differs from its staging twin. The plain form is blind to NULL on either side."""
    differs = F.lit(False)
    for column in columns:
        old, new = F.col(column), F.col(f"_new_{column}")
        differs = differs | (~old.eqNullSafe(new) if null_safe else F.coalesce(old != new, F.lit(False)))
    return differs


def _renamed(staging: DataFrame, key: str) -> DataFrame:
    return staging.select(F.col(key), F.lit(True).alias("_staged"), *[
        F.col(c).alias(f"_new_{c}") for c in staging.columns if c != key
    ])


def scd1_inserts(target: DataFrame, staging: DataFrame, key: str) -> DataFrame:
    """Staging rows whose key the target does not have.

    The target keys are first narrowed to those in staging, so only matches travel. Anti join keeps NULL keys, which
    never match.
    """
    matched = target.select(key).join(staging.select(key), key, "left_semi").distinct()
    return staging.join(matched, key, "left_anti")


def scd1_merge(
    target: DataFrame,
    staging: DataFrame,
    key: str,
    schema: T.StructType,
    as_of: dt.datetime,
    stamp: str = "last_update",
    only_changed: bool = False,
    kind: str | None = None,
) -> DataFrame:
    """Type 1: staging values replace those of a matching key, other staging rows are added, both stamped ``as_of``.

    ``only_changed`` leaves the stamp of rows that staging repeats without a difference. A key that staging has twice
    fails the merge; reduce it with ``newest_per_key`` first.
    """
    require_unique(staging, key)
    values = [f.name for f in schema.fields if f.name not in (key, stamp)]
    staged = conform(staging.withColumn(stamp, F.lit(as_of)), schema)
    merged = target.join(_renamed(staged, key), key, "left")
    replace = F.coalesce(F.col("_staged"), F.lit(False))
    if only_changed:
        replace = replace & _changed(values)
    def named(column: Column) -> list[Column]:
        return [] if kind is None else [column.alias(kind)]

    columns = {c: F.when(replace, F.col(f"_new_{c}")).otherwise(F.col(c)) for c in [*values, stamp]}
    updated = merged.select(
        *[columns.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields],
        *named(F.when(replace, "updated").otherwise("kept")))
    return updated.unionByName(scd1_inserts(target, staged, key).select("*", *named(F.lit("inserted"))))


def scd1_customer(target: DataFrame, staging: DataFrame, as_of: dt.datetime, only_changed: bool = False) -> DataFrame:
    return scd1_merge(target, staging, "CustomerID", CUSTOMER, as_of, only_changed=only_changed)


def scd1_branch(target: DataFrame, staging: DataFrame, as_of: dt.datetime, only_changed: bool = False) -> DataFrame:
    return scd1_merge(target, staging, "BranchID", BRANCH, as_of, only_changed=only_changed)


def scd2_close(
    history: DataFrame, staging: DataFrame, as_of: dt.datetime, key: str = "LoanID",
    tracked: Sequence[str] = LOAN_TRACKED, null_safe: bool = False, kind: str | None = None,
) -> DataFrame:
    """History with the current row closed where a tracked column differs from staging. A key twice in staging fails."""
    require_unique(staging, key)
    staged = _renamed(staging.select(key, *tracked), key)
    joined = history.join(staged, key, "left")
    close = F.col("is_current") & F.coalesce(F.col("_staged"), F.lit(False)) & _changed(tracked, null_safe)
    close = F.coalesce(close, F.lit(False))
    replaced = {
        "is_current": F.when(close, F.lit(False)).otherwise(F.col("is_current")),
        "valid_to": F.when(close, F.lit(as_of)).otherwise(F.col("valid_to")),
    }
    named = [] if kind is None else [F.when(close, "closed").otherwise("kept").alias(kind)]
    return joined.select(*[replaced.get(c, F.col(c)).alias(c) for c in history.columns], *named)


def as_current(staging: DataFrame, as_of: dt.datetime, schema: T.StructType = LOANS) -> DataFrame:
    """Staging rows as current versions that start at ``as_of``."""
    stamped = (
        staging.withColumn("is_current", F.lit(True)).withColumn("valid_from", F.lit(as_of))
        .withColumn("valid_to", F.lit(None).cast("timestamp"))
    )
    return conform(stamped, schema)


def scd2_append_all(history: DataFrame, staging: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Type 2, literal form: close what differs by ``!=``, then add every staging row, also unchanged ones."""
    return scd2_close(history, staging, as_of).unionByName(as_current(staging, as_of))


def scd2_merge(
    history: DataFrame, staging: DataFrame, as_of: dt.datetime, key: str = "LoanID",
    tracked: Sequence[str] = LOAN_TRACKED, kind: str | None = None,
) -> DataFrame:
    """Type 2 as meant: null-safe comparison, and only new or changed rows start a version."""
    current = history.filter(F.col("is_current")).select(key, *tracked)
    staged = _renamed(staging.select(key, *tracked), key)
    unchanged = current.join(staged, key).filter(~_changed(tracked)).select(key).distinct()
    added = staging.join(unchanged, key, "left_anti")
    opened = as_current(added, as_of).select("*", *([] if kind is None else [F.lit("inserted").alias(kind)]))
    return scd2_close(history, staging, as_of, key, tracked, null_safe=True, kind=kind).unionByName(opened)


def scd2_chain(
    current: DataFrame, staging: DataFrame, moment: str, key: str = "LoanID", tracked: Sequence[str] = LOAN_TRACKED,
    schema: T.StructType = LOANS, kind: str | None = None, ranges: int | None = None,
) -> DataFrame:
    """Type 2 with any number of versions of a key in one staging table, told apart by ``moment``.

    ``current`` holds the open versions of the staged keys (and may hold others). Staged rows follow the open version of
    their key in the order of ``moment``; one that differs from the row before it (null-safe) starts a version and closes
    the one before, others are left out. Two rows of a key at one moment, and rows no later than the open version, have no
    place in the chain and fail the merge. Rows without a key are versions of their own. A key with very many versions
    spans several tasks.
    """
    at, columns = "_at", [f.name for f in schema.fields]
    staged = staging.select(*staging.columns, F.col(moment).cast("timestamp").alias(at), F.lit(True).alias("_new"))
    opened = conform(
        staged.withColumn("is_current", F.lit(True)).withColumn("valid_from", F.col(at))
        .withColumn("valid_to", F.lit(None).cast("timestamp")), schema)
    before = current.select(*columns, F.lit(False).alias("_new"))
    known = before.filter(F.col(key).isNotNull())
    chain = known.unionByName(opened.filter(F.col(key).isNotNull()).withColumn("_new", F.lit(True)))
    # The open version comes first, so that rows that are no later than it are seen below.
    placed = with_previous(
        in_ranges(chain.withColumn(at, F.struct("_new", "valid_from")), key, at, ranges), key, at,
        [*tracked, "valid_from"], "_before")
    late = placed.filter(F.col("_new") & (F.col("valid_from") <= field("_before", "valid_from"))).select(key).first()
    if late is not None:
        raise ValueError(f"staging has a row for {key} = {late[0]} that is no later than the version before it")
    same = F.lit(True)
    for column in tracked:
        same = same & F.col(column).eqNullSafe(field("_before", column))
    versions = placed.filter(~F.col("_new") | F.col("_before").isNull() | ~same)
    ended = with_next(versions, key, at, ["valid_from"], "_after")
    closes = F.col("_after").isNotNull() & F.col("is_current")
    replaced = {
        "is_current": F.when(closes, F.lit(False)).otherwise(F.col("is_current")),
        "valid_to": F.when(closes, field("_after", "valid_from")).otherwise(F.col("valid_to")),
    }
    kinds = [] if kind is None else [
        F.when(F.col("_new"), "inserted").when(closes, "closed").otherwise("kept").alias(kind)]
    chained = without_range(ended).select(*[replaced.get(c, F.col(c)).alias(c) for c in columns], *kinds)

    def alone(rows: DataFrame, what: str) -> DataFrame:
        return rows.filter(F.col(key).isNull()).select(*columns, *([] if kind is None else [F.lit(what).alias(kind)]))

    return chained.unionByName(alone(before, "kept")).unionByName(alone(opened, "inserted"))


def current_rows(history: DataFrame) -> DataFrame:
    return history.filter(F.col("is_current"))


def rows_as_of(history: DataFrame, moment: dt.datetime) -> DataFrame:
    """Versions that were valid at ``moment``."""
    at = F.lit(moment)
    return history.filter((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (at < F.col("valid_to"))))
