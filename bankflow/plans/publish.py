"""Reports as tables: every report is cast to its declared columns, written as a new version and committed.

Readers see the last committed version of each report, a whole one; a run that dies leaves the ones before it in place, and
a rerun of the same batch publishes only what is still missing. The rows are counted while they are written.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankflow import schemas
from bankflow.operators import accounts as acc
from bankflow.operators import countries as cty
from bankflow.operators import fraud, ledger, prefix, reconciliation, risk
from bankflow.plans.workspace import materialize
from bankflow.schemas import conform
from bankflow.sources.snapshots import SnapshotTable

Inputs = dict[str, DataFrame]
Report = Callable[[SparkSession, Inputs, dt.date], DataFrame]

# Tables written at a time. Few stages of one report keep all cores busy; Spark gives the idle ones to the next report.
AT_A_TIME = 6

# Name of the table, its declared columns (None: those of the query, as a table made from a select has), and the query.
REPORTS: dict[str, tuple[T.StructType | None, Report]] = {
    "account_ledger": (None, lambda spark, t, as_of: ledger.ledger_flattened(
        t["accounts"], t["payments"], t["transactions"], as_of=as_of)),
    "potential_fraud_accounts": (schemas.POTENTIAL_FRAUD_ACCOUNTS, lambda spark, t, _: fraud.potential_fraud_accounts(
        t["accounts"], t["transactions"], t["payments"])),
    "reconciliation_report": (schemas.RECONCILIATION_REPORT, lambda spark, t, _: (
        reconciliation.payment_reconciliation(t["payments"]))),
    "activity_heatmap": (schemas.ACTIVITY_HEATMAP, lambda spark, t, _: acc.activity_heatmap(t["transactions"])),
    "portfolio_risk": (schemas.PORTFOLIO_RISK, lambda spark, t, _: risk.portfolio_risk(
        t["accounts"], risk.exchange_rates(spark))),
    "fee_leakage": (schemas.FEE_LEAKAGE, lambda spark, t, _: acc.fee_leakage(t["transactions"])),
    "customer_profitability": (schemas.CUSTOMER_PROFITABILITY, lambda spark, t, _: prefix.customer_profitability(
        t["accounts"], t["transactions"])),
    "cross_sell_opportunities": (schemas.CROSS_SELL_OPPORTUNITIES, lambda spark, t, _: prefix.cross_sell_opportunities(
        t["accounts"], t["transactions"])),
    "clearing_system_efficiency": (schemas.CLEARING_SYSTEM_EFFICIENCY, lambda spark, t, _: (
        prefix.clearing_system_efficiency(t["payments"], t["transactions"]))),
    "country_risk_category": (None, lambda spark, t, _: cty.country_risk_category(t["countries"])),
    "currency_details": (None, lambda spark, t, _: cty.currency_details(t["countries"])),
    "largest_country_per_region": (None, lambda spark, t, _: cty.largest_country_per_region(t["countries"])),
}


class ReportTables:
    """The published reports under one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _table(self, name: str, schema: T.StructType) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.root}/{name}", schema)

    def publish(self, name: str, rows: DataFrame, batch: str, schema: T.StructType | None = None) -> int:
        """Next version of a report; returns its number of rows. A batch that was published before stays as it is."""
        declared = rows if schema is None else conform(rows, schema)
        table = self._table(name, declared.schema)
        table.commit(declared, batch)
        return table.row_count()

    def read(self, name: str) -> DataFrame:
        """The current version, with the columns that it was written with."""
        version = self._table(name, T.StructType()).version()
        if version is None:
            raise ValueError(f"{name} has not been published")
        return self.spark.read.parquet(f"{self.root}/{name}/v={version}")

    def register(self, name: str) -> None:
        """The current version as a view of the session, for SQL."""
        self.read(name).createOrReplaceTempView(name)


def _at_once(spark: SparkSession, write: Callable[[str], object], names: Iterable[str]) -> dict[str, object]:
    """Result of ``write`` by name. The jobs of the first names go first; the first failure is raised once all have ended."""
    with ThreadPoolExecutor(AT_A_TIME) as pool:
        jobs = {name: pool.submit(inheritable_thread_target(spark)(write), name) for name in names}
    return {name: job.result() for name, job in jobs.items()}


def publish_reports(
    spark: SparkSession, root: str, inputs: Inputs, as_of: dt.date, batch: str, names: list[str] | None = None
) -> dict[str, int]:
    """Publish the reports (all by default) over ``inputs``: accounts, transactions, payments and countries. The inputs are
    written once, as nearly every report reads them. Inputs, then reports, are written several at a time."""
    written = _at_once(spark, lambda name: materialize(inputs[name], name), inputs)
    tables = ReportTables(spark, root)

    def publish(name: str) -> int:
        schema, report = REPORTS[name]
        return tables.publish(name, report(spark, written, as_of), batch, schema)

    return _at_once(spark, publish, names or REPORTS)


def published_counts(spark: SparkSession, root: str, names: list[str] | None = None) -> DataFrame:
    """``report, row_count`` of the published reports, read back."""
    tables = ReportTables(spark, root)
    counts = None
    for name in names or REPORTS:
        one = tables.read(name).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("report"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    return counts
