"""Versioned Parquet tables in hash buckets, of which a change rewrites only what it touches.

Rows lie in buckets by a hash of their key. A manifest, one per version, names for every bucket the data versions that hold
its rows, so a new version writes the buckets of the changed keys and points at the old files for all others. Rows that no
merge will look at again (``settled``, such as closed versions of a history) lie apart and are only ever added to, until
``compact`` joins the pieces of a bucket. A version becomes visible by its commit row; a writer that died before it is
replaced by the next attempt. One writer at a time.

The driver handles the manifest alone: a row for each bucket and piece, whatever the number of rows in the table.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a merge did with a row.
KEPT, UPDATED, INSERTED, CLOSED = KINDS = ("kept", "updated", "inserted", "closed")

_COMMITS = "version bigint, batch string, kept bigint, updated bigint, inserted bigint, closed bigint"
_MANIFEST = "bucket int, area string, data_version bigint, row_count bigint"
_MANIFEST_FIELDS = _MANIFEST.replace(" ", ":").replace(",:", ",")
_OPEN, _SETTLED = "open", "settled"


@dataclass(frozen=True)
class MergeCounts:
    """Rows of the table by what the merge did with them; ``kept`` includes those in buckets it did not read."""

    version: int
    kept: int
    updated: int
    inserted: int
    closed: int


class BucketedTable:
    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int = 64,
        settled: Column | None = None,
    ):
        """``settled`` tells the rows that no later merge compares or changes. The number of buckets stays as it is for
        the life of the table; a bucket should fit the memory of a few tasks."""
        self.spark, self.path, self.schema, self.key, self.buckets = spark, path, schema, key, buckets
        self.settled = F.lit(False) if settled is None else F.coalesce(settled, F.lit(True))
        # An empty log from the start, so that reading it never depends on whether it exists.
        spark.createDataFrame([], _COMMITS).write.mode("ignore").parquet(f"{path}/commits")

    def log(self) -> DataFrame:
        """A row for each version: its batch, and the counts of the merge that made it."""
        return self.spark.read.schema(_COMMITS).parquet(f"{self.path}/commits")

    def version(self) -> int | None:
        return self._state("")[0]

    def has_batch(self, batch: str) -> bool:
        return self._state(batch)[1]

    def _state(self, batch: str) -> tuple[int | None, bool]:
        row = self.log().agg(F.max("version"), F.bool_or(F.col("batch") == batch)).first()
        return row[0], bool(row[1])

    def bucket_of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def manifest(self, version: int | None = None) -> list[Row]:
        """Where the rows of a version (the current one by default) lie."""
        version = self.version() if version is None else version
        if version is None:
            return []
        return self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifest/v={version}").collect()

    def _folder(self, piece: Row) -> str:
        return f"{self.path}/data/v={piece['data_version']}/_area={piece['area']}/_bucket={piece['bucket']}"

    def _read(self, pieces: Iterable[Row]) -> DataFrame:
        folders = [self._folder(piece) for piece in pieces]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of the current version, or of an earlier one."""
        return self._read(self.manifest(version))

    def read_open(self) -> DataFrame:
        """Rows that are not settled; pieces with settled ones are not read."""
        return self._read(piece for piece in self.manifest() if piece["area"] == _OPEN)

    def touched(self, rows: DataFrame) -> list[int]:
        """Buckets that the keys of ``rows`` fall into: at most the number of buckets."""
        return sorted(r[0] for r in rows.select(self.bucket_of(F.col(self.key))).distinct().collect())

    def lookup(self, keys: DataFrame) -> DataFrame:
        """Rows with one of ``keys`` (a column of the key's name); other buckets are not read."""
        wanted = set(self.touched(keys))
        rows = self._read(piece for piece in self.manifest() if piece["bucket"] in wanted)
        return rows.join(keys.select(self.key).distinct(), self.key, "left_semi")

    def merge(self, staged: DataFrame, change: Callable[[DataFrame], DataFrame], batch: str) -> MergeCounts | None:
        """Next version: ``change`` gets the open rows of the buckets that ``staged`` touches and returns what they become,
        with a column ``_kind``. Kinds are counted while the rows are written. A batch that was merged before is left out
        (None)."""
        current, done = self._state(batch)
        if done:
            return None
        old = self.manifest(current) if current is not None else []
        version = 0 if current is None else current + 1
        wanted = set(self.touched(staged))
        replaced = [p for p in old if p["area"] == _OPEN and p["bucket"] in wanted]
        staying = [p for p in old if not (p["area"] == _OPEN and p["bucket"] in wanted)]
        changed = change(self._read(replaced))
        seen = Observation(f"merge_{version}")
        self._write(changed, version, seen)
        counts = MergeCounts(
            version, seen.get[KEPT] + sum(p["row_count"] for p in staying), *(seen.get[kind] for kind in KINDS[1:]))
        self._commit(version, staying + self._written(version), batch, counts)
        return counts

    def compact(self, batch: str, most_pieces: int = 4) -> int | None:
        """Join the settled pieces of buckets that have more than ``most_pieces``; the rows stay as they are."""
        current, done = self._state(batch)
        if done or current is None:
            return current
        old = self.manifest(current)
        pieces: dict[int, list[Row]] = {}
        for piece in old:
            if piece["area"] == _SETTLED:
                pieces.setdefault(piece["bucket"], []).append(piece)
        crowded = [p for held in pieces.values() if len(held) > most_pieces for p in held]
        if not crowded:
            return current
        version = current + 1
        self._write(self._read(crowded), version)
        counts = MergeCounts(version, sum(p["row_count"] for p in old), 0, 0, 0)
        self._commit(version, [p for p in old if p not in crowded] + self._written(version), batch, counts)
        return version

    def _write(self, rows: DataFrame, version: int, seen: Observation | None = None) -> None:
        kinds = [] if seen is None else ["_kind"]
        placed = rows.select(
            *(F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields), *kinds,
            F.when(self.settled, _SETTLED).otherwise(_OPEN).alias("_area"),
            self.bucket_of(F.col(self.key)).alias("_bucket")).hint("rebalance", "_area", "_bucket")
        # A small bucket becomes one file, a large one is split. Counted in the tasks that write, which count once even
        # if a stage before them has to run again.
        if seen is not None:
            placed = placed.observe(seen, *(
                F.coalesce(F.sum(F.when(F.col("_kind") == kind, 1)), F.lit(0)).alias(kind) for kind in KINDS))
        placed.drop(*kinds).write.mode("overwrite").partitionBy("_area", "_bucket").parquet(
            f"{self.path}/data/v={version}")

    def _written(self, version: int) -> list[Row]:
        """Pieces of a data version, counted from the footers of its files."""
        stored = T.StructType([*self.schema.fields, T.StructField("_area", T.StringType()),
                               T.StructField("_bucket", T.IntegerType())])
        rows = self.spark.read.schema(stored).parquet(f"{self.path}/data/v={version}")
        return rows.groupBy(F.col("_bucket").alias("bucket"), F.col("_area").alias("area")).agg(
            F.lit(version).cast("long").alias("data_version"), F.count(F.lit(1)).alias("row_count")).collect()

    def _commit(self, version: int, pieces: list[Row], batch: str, counts: MergeCounts) -> None:
        rows = F.from_json(F.lit(json.dumps([p.asDict() for p in pieces])), f"array<struct<{_MANIFEST_FIELDS}>>")
        self.spark.range(1, numPartitions=1).select(F.inline(rows)).write.mode("overwrite").parquet(
            f"{self.path}/manifest/v={version}")
        values = {"version": version, "batch": batch} | {kind: getattr(counts, kind) for kind in KINDS}
        entry = self.spark.range(1, numPartitions=1).select(
            *(F.lit(value).cast("string" if name == "batch" else "long").alias(name) for name, value in values.items()))
        entry.write.mode("append").parquet(f"{self.path}/commits")
