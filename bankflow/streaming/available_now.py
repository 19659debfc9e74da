"""File-source streams that apply staged changes once and stop.

The table is a ``BucketedTable``, of which a micro-batch rewrites only what it touches, or a ``SnapshotTable``, which is
small enough to be written whole.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankflow.operators.scd import newest_per_key, scd1_merge, scd2_chain, scd2_merge
from bankflow.plans.merges import merge_type1, merge_type2, merge_type2_chain
from bankflow.sources.bucketed import BucketedTable
from bankflow.sources.snapshots import SnapshotTable

Table = SnapshotTable | BucketedTable


def _run(
    spark: SparkSession, staging_path: str, staging_schema: T.StructType, checkpoint: str, table: Table,
    merge: Callable[[DataFrame, str], object],
) -> None:
    """Each micro-batch becomes one version. The batch number is committed with it, so a replayed batch is skipped."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        name = f"stream-{batch_id}"
        if not table.has_batch(name):
            merge(batch, name)

    query = (
        spark.readStream.schema(staging_schema).parquet(staging_path)
        .writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def _one_per_key(batch: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """Newest rows, if the caller says which those are; else the batch as it is, and the merge refuses repeated keys."""
    return newest_per_key(batch, key, order_by) if order_by else batch


def stream_scd1(
    spark: SparkSession, staging_path: str, staging_schema: T.StructType, checkpoint: str, table: Table,
    key: str, as_of: dt.datetime, order_by: Sequence[str] = (),
) -> DataFrame:
    """Merge all staging files that arrived since the last run (type 1) and return the current rows.

    Several rows of one key in a batch are reduced to the greatest by ``order_by``; without it they are an error.
    """

    def merge(batch: DataFrame, name: str) -> None:
        staged = _one_per_key(batch, key, order_by)
        if isinstance(table, BucketedTable):
            merge_type1(table, staged, as_of, name)
        else:
            table.commit(scd1_merge(table.read(), staged, key, table.schema, as_of), name)

    _run(spark, staging_path, staging_schema, checkpoint, table, merge)
    return table.read()


def stream_scd2(
    spark: SparkSession, staging_path: str, staging_schema: T.StructType, checkpoint: str, table: Table,
    key: str, as_of: dt.datetime | None = None, order_by: Sequence[str] = (), moment: str | None = None,
) -> DataFrame:
    """The same with history (type 2).

    With ``moment``, a column of the staged rows, every version of a key in a batch enters the history, valid from its own
    moment until that of the next one; a batch of several days gives what a run after each day would have given. Without
    it all rows of a batch are valid from ``as_of``; then ``order_by`` keeps only the newest of several versions, and
    without ``order_by`` they are an error.
    """
    if (moment is None) == (as_of is None):
        raise ValueError("give either the moment column of the staged rows or as_of")

    def merge(batch: DataFrame, name: str) -> None:
        if moment is not None and isinstance(table, BucketedTable):
            merge_type2_chain(table, batch, moment, name)
        elif moment is not None:
            history = table.read()
            closed = history.filter(~F.coalesce("is_current", F.lit(False)))
            chained = scd2_chain(history.filter("is_current"), batch, moment, key, schema=table.schema)
            table.commit(closed.unionByName(chained), name)
        elif isinstance(table, BucketedTable):
            merge_type2(table, _one_per_key(batch, key, order_by), as_of, name)
        else:
            table.commit(scd2_merge(table.read(), _one_per_key(batch, key, order_by), as_of, key), name)

    _run(spark, staging_path, staging_schema, checkpoint, table, merge)
    return table.read()
