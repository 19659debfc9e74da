"""Versioned Parquet snapshots.

A Parquet folder cannot be overwritten while it is read, and an overwrite that dies half-way leaves neither the old nor
the new rows. So a changed table goes to a folder of its own and a commit row makes it current. Readers see the last
commit; a writer that died before its commit is replaced by the next attempt.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_COMMITS = "version bigint, batch string, row_count bigint"


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark = spark
        self.path = path
        self.schema = schema
        # An empty log from the start, so that reading it never depends on whether it exists.
        spark.createDataFrame([], _COMMITS).write.mode("ignore").parquet(f"{path}/commits")

    def _commits(self) -> DataFrame:
        return self.spark.read.schema(_COMMITS).parquet(f"{self.path}/commits")

    def version(self) -> int | None:
        return self._state("")[0]

    def row_count(self) -> int | None:
        """Rows of the current version, from the log."""
        row = self._commits().agg(F.max(F.struct("version", "row_count"))).first()[0]
        return None if row is None else row["row_count"]

    def has_batch(self, batch: str) -> bool:
        return self._state(batch)[1]

    def _state(self, batch: str) -> tuple[int | None, bool]:
        """Current version, and whether ``batch`` is committed."""
        row = self._commits().agg(F.max("version"), F.bool_or(F.col("batch") == batch)).first()
        return row[0], bool(row[1])

    def read(self, version: int | None = None) -> DataFrame:
        """The current snapshot (or an earlier one); an empty table before the first commit."""
        version = self.version() if version is None else version
        if version is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/v={version}")

    def commit(self, df: DataFrame, batch: str) -> int:
        """Write ``df`` as the next version, its rows counted on the way. A batch that was committed before is not written
        again."""
        current, done = self._state(batch)
        if done:
            return current
        version = 0 if current is None else current + 1
        # Tables may be committed side by side, so no two share a name.
        seen = Observation(f"commit-{uuid.uuid4().hex}")
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.mode("overwrite").parquet(f"{self.path}/v={version}")
        entry = self.spark.range(1, numPartitions=1).select(
            F.lit(version).cast("long").alias("version"), F.lit(batch).alias("batch"),
            F.lit(seen.get["rows"]).cast("long").alias("row_count"),
        )
        entry.write.mode("append").parquet(f"{self.path}/commits")
        return version
