"""Incremental loads from a source table to the raw layer, driven by a high-water mark.

Each load writes one batch folder and then one log row. Raw readers list the logged batches only, and a rerun after a
crash writes the same batch number again, so no row is loaded twice and no mark is ahead of its data.

The log is also the manifest of the raw layer: it has the first and last day in every batch, by which reads of a range of
days leave whole batches out. Many small batches are joined by ``compact`` into one folder cut by month, which takes the
place of their log rows, so the list of folders stays short.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from bankflow.functions import parse_day
from bankflow.sources.jdbc import read_partitioned

_LOG = (
    "table_name string, batch bigint, row_count bigint, mark date, load_dt date, first_day date, last_day date, "
    "undated bigint, replaces bigint"
)
# Month of a row's day, the folders of compacted batches; rows without a day are in a folder of their own.
_MONTH = "_month"


@dataclass(frozen=True)
class TableSpec:
    """What a load has to know about one source table."""

    name: str
    key: str
    date_column: str
    read_partitions: int
    date_is_text: bool = False
    # The load date in the dialect of the source; the plain column unless the date is kept as text.
    source_day: str | None = None

    def day(self) -> Column:
        """The load date as a date; text in ``dd-MM-yyyy`` order would compare by day of month first."""
        column = F.col(self.date_column)
        return parse_day(column) if self.date_is_text else column.cast("date")


ACCOUNTS = TableSpec("accounts", "AccountID", "DateOpened", 4)
TRANSACTIONS = TableSpec(
    "transactions", "TransactionID", "TransactionDate", 6, date_is_text=True,
    source_day="str_to_date(TransactionDate, '%d-%m-%Y')",
)
PAYMENTS = TableSpec("payments", "PaymentID", "PaymentDate", 6)
BANK_TABLES = (ACCOUNTS, TRANSACTIONS, PAYMENTS)


@dataclass(frozen=True)
class LoadResult:
    table_name: str
    batch: int
    row_count: int
    mark: dt.date | None
    first_day: dt.date | None = None
    last_day: dt.date | None = None
    undated: int = 0


class RawLayer:
    """Raw tables under one root, with the log of committed batches."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        spark.createDataFrame([], _LOG).write.mode("ignore").parquet(f"{root}/log")

    def log(self) -> DataFrame:
        return self.spark.read.schema(_LOG).parquet(f"{self.root}/log")

    def last(self, table: str) -> tuple[int, dt.date | None]:
        """Last committed batch number (-1 if none) and the mark."""
        row = (
            self.log().filter(F.col("table_name") == table)
            .agg(F.max("batch").alias("batch"), F.max("mark").alias("mark")).first()
        )
        return (-1 if row["batch"] is None else row["batch"]), row["mark"]

    def batches(self, table: str) -> list[Row]:
        """Log rows of the folders that hold the table: the newest compacted one, and the batches after it."""
        log = self.log().filter((F.col("table_name") == table) & (F.col("row_count") > 0)).collect()
        joined = max((b for b in log if b["replaces"] is not None), key=lambda b: b["batch"], default=None)
        kept = [b for b in log if joined is None or b["batch"] >= joined["batch"]]
        return sorted(kept, key=lambda b: b["batch"])

    def _read(
        self, table: str, batches: list[Row], with_batch: bool = False, months: tuple[str, str] | None = None
    ) -> DataFrame:
        """Rows of some batches. Compacted ones lie in folders by month, of which ``months`` picks a range."""
        parts = []
        for joined in (False, True):
            folders = [
                f"{self.root}/{table}/batch={b['batch']}" for b in batches if (b["replaces"] is not None) == joined]
            if folders:
                rows = self.spark.read.option("basePath", f"{self.root}/{table}").parquet(*folders)
                if joined and months is not None:
                    rows = rows.filter(F.col(_MONTH).between(*months))
                parts.append(rows.drop(_MONTH) if with_batch else rows.drop("batch", _MONTH))
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def read(self, table: str, with_batch: bool = False) -> DataFrame | None:
        """All committed rows of a raw table, or None before its first load. ``with_batch`` keeps the number of the batch;
        rows of compacted batches have that of the compaction."""
        held = self.batches(table)
        return self._read(table, held, with_batch) if held else None

    def read_days(self, spec: TableSpec, first: dt.date, last: dt.date) -> DataFrame | None:
        """Rows from day ``first`` to ``last``. Batches without such a day are not read, nor are other months of a
        compacted one."""
        held = self.batches(spec.name)
        if not held:
            return None
        fitting = [b for b in held if b["last_day"] is not None and b["first_day"] <= last and b["last_day"] >= first]
        if not fitting:
            return self._read(spec.name, held[:1]).limit(0)
        rows = self._read(spec.name, fitting, months=(f"{first:%Y-%m}", f"{last:%Y-%m}"))
        return rows.filter(spec.day().between(F.lit(first), F.lit(last)))

    def compact(self, spec: TableSpec, load_dt: dt.date) -> int | None:
        """Join the batches of a table into one folder, cut by month; None if there are fewer than two."""
        held = self.batches(spec.name)
        if len(held) < 2:
            return None
        last_batch, mark = self.last(spec.name)
        batch = last_batch + 1
        month = F.coalesce(F.date_format(spec.day(), "yyyy-MM"), F.lit("none"))
        self._read(spec.name, held).withColumn(_MONTH, month).hint("rebalance", _MONTH, "load_dt").write.mode(
            "overwrite").partitionBy(_MONTH, "load_dt").parquet(f"{self.root}/{spec.name}/batch={batch}")
        days = [b[c] for b in held for c in ("first_day", "last_day") if b[c] is not None]
        self.commit(LoadResult(
            spec.name, batch, sum(b["row_count"] for b in held), mark, min(days, default=None), max(days, default=None),
            sum(b["undated"] for b in held)), load_dt, replaces=batch - 1)
        return batch

    def commit(self, result: LoadResult, load_dt: dt.date, replaces: int | None = None) -> None:
        values = (result.table_name, result.batch, result.row_count, result.mark, load_dt, result.first_day,
                  result.last_day, result.undated, replaces)
        names = [column.split()[0] for column in _LOG.split(", ")]
        types = [column.split()[1] for column in _LOG.split(", ")]
        entry = self.spark.range(1, numPartitions=1).select(
            *(F.lit(v).cast(t).alias(n) for v, n, t in zip(values, names, types, strict=True)))
        entry.write.mode("append").parquet(f"{self.root}/log")


def stamp(df: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Load date and load time, one value for the whole run."""
    return df.withColumn("load_dt", F.lit(as_of.date())).withColumn("load_ts", F.lit(as_of))


def increment(source: DataFrame, spec: TableSpec, mark: dt.date | None, with_nulls: bool = False) -> DataFrame:
    """Rows after the mark; everything when there is none. A plain filter, so file and JDBC sources push it down."""
    if mark is None:
        return source
    newer = spec.day() > F.lit(mark)
    return source.filter(newer | spec.day().isNull() if with_nulls else newer)


def load(
    source: DataFrame, spec: TableSpec, raw: RawLayer, as_of: dt.datetime, overlap_days: int = 0
) -> LoadResult:
    """Load what is new. Write, row count, days and new mark come from one pass over the source.

    With ``overlap_days`` the load reads back that far behind the mark, and reads the rows without a date, and leaves out
    keys that the raw table already has there: late rows of a loaded day are picked up, and none is stored twice. A table
    of which no row has a date is compared by key as a whole.
    """
    last_batch, mark = raw.last(spec.name)
    since = mark if mark is None else mark - dt.timedelta(days=overlap_days)
    fresh = increment(source, spec, since, overlap_days > 0)
    undated_only = mark is None and last_batch >= 0
    if undated_only or (overlap_days and mark is not None):
        loaded = increment(raw.read(spec.name), spec, since, True).select(spec.key).distinct()
        fresh = fresh.join(loaded, spec.key, "left_anti")

    seen = Observation(f"load_{spec.name}")
    day = spec.day()
    stamped = stamp(fresh, as_of).observe(
        seen, F.count(F.lit(1)).alias("row_count"), F.max(day).alias("last_day"), F.min(day).alias("first_day"),
        F.count_if(day.isNull()).alias("undated"),
    )
    batch = last_batch + 1
    stamped.write.mode("overwrite").partitionBy("load_dt").parquet(f"{raw.root}/{spec.name}/batch={batch}")
    found = seen.get
    if found["row_count"] == 0:
        return LoadResult(spec.name, last_batch, 0, mark)
    days = [d for d in (mark, found["last_day"]) if d is not None]
    result = LoadResult(
        spec.name, batch, found["row_count"], max(days, default=None), found["first_day"], found["last_day"],
        found["undated"])
    raw.commit(result, as_of.date())
    return result


def jdbc_source(
    spark: SparkSession, connection: dict[str, str], spec: TableSpec, raw: RawLayer, overlap_days: int = 0
) -> DataFrame:
    """The source table of a load, read in parallel and already filtered at the database, text dates as dates. With
    ``overlap_days``, which the load must be given too, late rows and rows without a date are read as well."""
    _, mark = raw.last(spec.name)
    if mark is None:
        return read_partitioned(spark, connection, spec.name, spec.key, spec.read_partitions, spec.date_column, None)
    options = {"with_nulls": True} if overlap_days else {}
    return read_partitioned(
        spark, connection, spec.name, spec.key, spec.read_partitions, spec.source_day or spec.date_column,
        mark - dt.timedelta(days=overlap_days), **options
    )


def load_all(
    sources: dict[str, DataFrame], raw: RawLayer, as_of: dt.datetime, specs: Iterable[TableSpec] = BANK_TABLES
) -> list[LoadResult]:
    return [load(sources[spec.name], spec, raw, as_of) for spec in specs]
