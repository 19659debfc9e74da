"""Daily merges into bucketed tables: only the buckets of the staged keys are read and written.

Staging is written first: it is read several times (its buckets, the check for repeated keys, the joins), and the written
table carries its true size, so a small one is broadcast. The counts of a merge are observed in the plan that writes it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankflow.operators.scd import LOAN_TRACKED, scd1_merge, scd2_chain, scd2_merge
from bankflow.plans.workspace import materialize
from bankflow.sources.bucketed import BucketedTable, MergeCounts

_KIND = "_kind"


def seed(table: BucketedTable, rows: DataFrame, batch: str = "seed") -> MergeCounts | None:
    """First rows of a table."""
    rows = materialize(rows, "seed")
    return table.merge(rows, lambda old: old.withColumn(_KIND, F.lit("kept")).unionByName(
        rows.withColumn(_KIND, F.lit("inserted"))), batch)


def history_table(
    spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int = 64,
    is_current: Column | None = None,
) -> BucketedTable:
    """A table of versions: closed ones are settled, so a merge neither reads nor rewrites them."""
    return BucketedTable(
        spark, path, schema, key, buckets, settled=~(F.col("is_current") if is_current is None else is_current))


def merge_type1(
    table: BucketedTable, staging: DataFrame, as_of: dt.datetime, batch: str, stamp: str = "last_update",
    only_changed: bool = False,
) -> MergeCounts | None:
    """Upsert; see ``scd1_merge``."""
    staging = materialize(staging, "staging")
    return table.merge(staging, lambda old: scd1_merge(
        old, staging, table.key, table.schema, as_of, stamp, only_changed, _KIND), batch)


def merge_type2(
    table: BucketedTable, staging: DataFrame, as_of: dt.datetime, batch: str, tracked: Sequence[str] = LOAN_TRACKED,
) -> MergeCounts | None:
    """One version of a key at most, valid from ``as_of``; see ``scd2_merge``."""
    staging = materialize(staging, "staging")
    return table.merge(staging, lambda old: scd2_merge(old, staging, as_of, table.key, tracked, _KIND), batch)


def merge_type2_chain(
    table: BucketedTable, staging: DataFrame, moment: str, batch: str, tracked: Sequence[str] = LOAN_TRACKED,
) -> MergeCounts | None:
    """All versions of a key that staging has, in the order of ``moment``; see ``scd2_chain``."""
    staging = materialize(staging, "staging")
    return table.merge(
        staging, lambda old: scd2_chain(old, staging, moment, table.key, tracked, table.schema, _KIND), batch)
