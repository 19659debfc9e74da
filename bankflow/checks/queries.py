"""Every operator as a query over the test tables: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankflow import fixtures as fx
from bankflow.functions import day_gap, event_hour, event_weekday, id_prefix, parse_day, ratio, to_int64, year_month
from bankflow.operators import accounts as acc
from bankflow.operators import countries as cty
from bankflow.operators import fraud, joins, ledger, prefix, ranking, reconciliation, risk, scd
from bankflow.plans import incremental as inc
from bankflow.plans import merges, publish
from bankflow.plans.workspace import new_path
from bankflow.schemas import COUNTRIES, CUSTOMER, CUSTOMER_STAGING, LOANS, LOANS_STAGING, LOANS_STAGING_TIMED
from bankflow.sources import (
    BucketedTable,
    append_table,
    overwrite_table,
    read_csv_staging,
    read_json_lines,
    load_payloads,
    read_nested_json,
)
from bankflow.streaming import stream_scd1, stream_scd2

Query = Callable[[SparkSession, str], DataFrame]

SPOT_CHECK_CUSTOMERS = (0, 1, 2, 3, 4)
# Buckets of the merged tables; the test tables are small.
BUCKETS = 8


def times_as_text(df: DataFrame) -> DataFrame:
    """Timestamps as text, which reads the same in every client."""
    return df.select(*[
        F.date_format(f.name, "yyyy-MM-dd HH:mm:ss").alias(f.name) if f.dataType.typeName() == "timestamp"
        else F.col(f.name)
        for f in df.schema.fields
    ])


# Scans, sources and sinks

def scan_bounds(spark: SparkSession, sf: str) -> DataFrame:
    tables = {
        inc.ACCOUNTS: fx.accounts(spark, sf), inc.TRANSACTIONS: fx.transactions(spark, sf),
        inc.PAYMENTS: fx.payments(spark, sf),
    }
    bounds = [
        df.agg(F.min(spec.key).alias("lower_bound"), F.max(spec.key).alias("upper_bound"))
        .select(F.lit(spec.name).alias("table_name"), "lower_bound", "upper_bound")
        for spec, df in tables.items()
    ]
    return bounds[0].unionByName(bounds[1]).unionByName(bounds[2])


def scan_csv_staging(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "customer_csv")
    fx.customer_staging(spark, sf).write.option("header", True).csv(path)
    return read_csv_staging(spark, path, CUSTOMER_STAGING)


def scan_json_staging(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "loans_json")
    fx.loans_staging(spark, sf, 1).write.json(path)
    return read_json_lines(spark, path, LOANS_STAGING)


def _landed_countries(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "countries_json")
    fx.countries(spark, sf).write.json(path)
    return read_nested_json(spark, path, COUNTRIES, multi_line=False)


def scan_nested_json(spark: SparkSession, sf: str) -> DataFrame:
    return _landed_countries(spark, sf).select(
        F.col("name.common").alias("common"), F.col("name.nativeName")["eng"]["official"].alias("native_official"),
        "region", "subregion", "population", F.size("currencies").cast("bigint").alias("currencies"),
        F.col("tld")[0].alias("tld"), F.col("latlng")[1].alias("longitude"), "area", F.col("car.side").alias("car_side"),
    )


def sink_append(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "appended")
    for moment in (fx.DAY_1, fx.DAY_2):
        append_table(inc.stamp(fx.accounts(spark, sf), moment), path, partition_by=["load_dt"])
    return spark.read.parquet(path).select("AccountID", "Balance", "load_dt")


def sink_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "replaced")
    overwrite_table(fx.customer_staging(spark, sf), path, CUSTOMER_STAGING)
    overwrite_table(fx.customer_target(spark, sf), path, CUSTOMER)
    return times_as_text(spark.read.parquet(path))


# Incremental loads

def _sources(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        "accounts": fx.accounts(spark, sf), "transactions": fx.transactions(spark, sf),
        "payments": fx.payments(spark, sf),
    }


def _results(spark: SparkSession, results: list[inc.LoadResult]) -> DataFrame:
    return spark.createDataFrame(
        [(r.table_name, r.row_count, r.mark) for r in results], "table_name string, row_count bigint, mark date"
    )


def load_full(spark: SparkSession, sf: str) -> DataFrame:
    raw = inc.RawLayer(spark, new_path(spark, "raw"))
    inc.load(fx.accounts(spark, sf), inc.ACCOUNTS, raw, fx.DAY_1)
    return raw.read("accounts").drop("load_ts")


def load_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """A first load of what had happened by mid 2000, then the increment, told apart by their load date."""
    raw = inc.RawLayer(spark, new_path(spark, "raw"))
    source, spec = fx.transactions(spark, sf), inc.TRANSACTIONS
    inc.load(source.filter(spec.day() <= F.lit("2000-06-30").cast("date")), spec, raw, fx.DAY_1)
    inc.load(source, spec, raw, fx.DAY_2)
    return raw.read("transactions").select("TransactionID", "TransactionDate", "Amount", "load_dt")


def load_incremental_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """The same where every tenth transaction arrives after its day was loaded: the overlap finds those of its 60 days."""
    raw = inc.RawLayer(spark, new_path(spark, "raw"))
    source, spec = fx.transactions(spark, sf), inc.TRANSACTIONS
    in_time = (spec.day() <= F.lit("2000-06-30").cast("date")) & (F.col("TransactionID") % 10 != 0)
    inc.load(source.filter(in_time), spec, raw, fx.DAY_1)
    inc.load(source, spec, raw, fx.DAY_2, overlap_days=60)
    return raw.read("transactions").select("TransactionID", "TransactionDate", "load_dt")


def raw_day_range(spark: SparkSession, sf: str) -> DataFrame:
    """Transactions of one quarter from a raw table of three batches; the batches of other years are not read."""
    raw = inc.RawLayer(spark, new_path(spark, "raw"))
    source, spec = fx.transactions(spark, sf), inc.TRANSACTIONS
    for last, moment in ((dt.date(1998, 12, 31), fx.DAY_1), (dt.date(2000, 6, 30), fx.DAY_1), (None, fx.DAY_2)):
        inc.load(source if last is None else source.filter(spec.day() <= F.lit(last)), spec, raw, moment)
    return raw.read_days(spec, dt.date(2000, 1, 1), dt.date(2000, 3, 31)).select(
        "TransactionID", "TransactionDate", "Amount")


def load_incremental_empty(spark: SparkSession, sf: str) -> DataFrame:
    raw = inc.RawLayer(spark, new_path(spark, "raw"))
    source = fx.payments(spark, sf)
    inc.load(source, inc.PAYMENTS, raw, fx.DAY_1)
    return _results(spark, [inc.load(source, inc.PAYMENTS, raw, fx.DAY_2)])


def load_all_tables(spark: SparkSession, sf: str) -> DataFrame:
    raw = inc.RawLayer(spark, new_path(spark, "raw"))
    return _results(spark, inc.load_all(_sources(spark, sf), raw, fx.DAY_1))


def load_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per batch of a raw table, against the count that the load itself observed."""
    raw = inc.RawLayer(spark, new_path(spark, "raw"))
    inc.load(fx.transactions(spark, sf), inc.TRANSACTIONS, raw, fx.DAY_1)
    stored = raw.read("transactions", with_batch=True).groupBy("batch", "load_dt").agg(
        F.count(F.lit(1)).alias("stored_rows"))
    observed = raw.log().filter("table_name = 'transactions'").select(
        "batch", "load_dt", F.col("row_count").alias("observed_rows"))
    return stored.join(observed, ["batch", "load_dt"]).drop("batch")


def watermark_max(spark: SparkSession, sf: str) -> DataFrame:
    return fx.transactions(spark, sf).agg(F.max(inc.TRANSACTIONS.day()).alias("mark"))


# Scalar functions

def scalar_dates(spark: SparkSession, sf: str) -> DataFrame:
    day = parse_day(F.col("TransactionDate"))
    return fx.transactions(spark, sf).select(
        "TransactionID", day.alias("day"), year_month(day).alias("year_month"),
        event_weekday(F.col("EventTs")).alias("weekday"), event_hour(F.col("EventTs")).alias("hour"),
        day_gap(F.lit(fx.AS_OF), day).alias("age_days"), F.add_months(day, -12).alias("year_before"),
    )


def scalar_casts(spark: SparkSession, sf: str) -> DataFrame:
    return fx.accounts(spark, sf).select(
        "AccountID", F.col("AccountID").cast("string").alias("as_text"), id_prefix(F.col("AccountID")).alias("prefix"),
        to_int64(F.col("Balance") / 4).alias("rounded"), F.col("CreditScore").cast("double").alias("as_double"),
        F.col("DateOpened").cast("string").cast("date").alias("as_date"),
    )


def scalar_conditionals(spark: SparkSession, sf: str) -> DataFrame:
    return fx.accounts(spark, sf).select(
        "AccountID", F.abs("Balance").alias("absolute"),
        ratio(F.col("Balance"), F.col("ODLimit")).alias("guarded_ratio"),
        F.when(F.col("Balance") < 0, "debt").when(F.col("Balance") < 1000, "low").otherwise("funded").alias("band"),
        ((F.col("Currency") == "EUR") | ((F.col("CreditScore") >= 700) & (F.col("Balance") != 0))).alias("either"),
        F.lit(None).cast("double").alias("nothing"),
    )


# Slowly changing dimensions

def scd1_customer(spark: SparkSession, sf: str) -> DataFrame:
    return times_as_text(scd.scd1_customer(fx.customer_target(spark, sf), fx.customer_staging(spark, sf), fx.DAY_1))


def _customers(spark: SparkSession, sf: str, steps: tuple[int, ...] = (2, 3)) -> BucketedTable:
    """The target with the staging tables of one or two days merged into it."""
    table = BucketedTable(spark, new_path(spark, "customer"), CUSTOMER, "CustomerID", BUCKETS)
    merges.seed(table, fx.customer_target(spark, sf))
    for day, (step, moment) in enumerate(zip(steps, (fx.DAY_1, fx.DAY_2), strict=False), 1):
        merges.merge_type1(table, fx.customer_staging(spark, sf, step), moment, f"day {day}")
    return table


def scd1_customer_day2(spark: SparkSession, sf: str) -> DataFrame:
    return times_as_text(_customers(spark, sf).read())


def scd1_inserts_only(spark: SparkSession, sf: str) -> DataFrame:
    return scd.scd1_inserts(fx.customer_target(spark, sf), fx.customer_staging(spark, sf), "CustomerID")


def scd1_branch(spark: SparkSession, sf: str) -> DataFrame:
    return times_as_text(scd.scd1_branch(fx.branch_target(spark, sf), fx.branch_staging(spark, sf), fx.DAY_1))


def _loans(spark: SparkSession, sf: str) -> BucketedTable:
    table = merges.history_table(spark, new_path(spark, "loans"), LOANS, "LoanID", BUCKETS)
    for day, moment in ((1, fx.DAY_1), (2, fx.DAY_2)):
        merges.merge_type2(table, fx.loans_staging(spark, sf, day), moment, f"day {day}")
    return table


def scd2_close(spark: SparkSession, sf: str) -> DataFrame:
    history = scd.as_current(fx.loans_staging(spark, sf, 1), fx.DAY_1)
    return times_as_text(scd.scd2_close(history, fx.loans_staging(spark, sf, 2), fx.DAY_2))


def scd2_loans_literal(spark: SparkSession, sf: str) -> DataFrame:
    history = scd.scd2_append_all(spark.createDataFrame([], LOANS), fx.loans_staging(spark, sf, 1), fx.DAY_1)
    return times_as_text(scd.scd2_append_all(history, fx.loans_staging(spark, sf, 2), fx.DAY_2))


def scd2_loans(spark: SparkSession, sf: str) -> DataFrame:
    return times_as_text(_loans(spark, sf).read())


def scd2_current(spark: SparkSession, sf: str) -> DataFrame:
    """Open versions; the closed ones lie apart and are not read."""
    return times_as_text(_loans(spark, sf).read_open())


def scd2_as_of(spark: SparkSession, sf: str) -> DataFrame:
    return times_as_text(scd.rows_as_of(_loans(spark, sf).read(), fx.DAY_1))


def scd_audit(spark: SparkSession, sf: str) -> DataFrame:
    """What each merge did with the rows, from the log that it wrote."""
    logs = [
        table.log().filter("batch <> 'seed'").select(
            F.lit(name).alias("table_name"), "batch", "kept", "updated", "inserted", "closed")
        for name, table in (("customer", _customers(spark, sf)), ("loans", _loans(spark, sf)))
    ]
    return logs[0].unionByName(logs[1])


def staging_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as customer events: the newest event of each customer."""
    events = fx.read(spark, sf, "orders").select(
        F.col("o_custkey").alias("CustomerID"), F.col("o_orderdate").cast("date").alias("event_day"),
        F.col("o_orderkey").alias("event_id"), F.col("o_orderpriority").alias("note"),
    )
    return scd.newest_per_key(events, "CustomerID", ["event_day", "event_id"])


def stream_scd1_available_now(spark: SparkSession, sf: str) -> DataFrame:
    staged = new_path(spark, "stream_staging")
    fx.customer_staging(spark, sf).write.parquet(staged)
    table = _customers(spark, sf, ())
    merged = stream_scd1(
        spark, staged, CUSTOMER_STAGING, new_path(spark, "stream_checkpoint"), table, "CustomerID", fx.DAY_1
    )
    return times_as_text(merged)


def stream_scd2_available_now(spark: SparkSession, sf: str) -> DataFrame:
    """The files of both days in one run; every version of a loan enters the history."""
    staged = new_path(spark, "stream_staging")
    for day, moment in ((1, fx.DAY_1), (2, fx.DAY_2)):
        fx.loans_staging(spark, sf, day).withColumn("arrived", F.lit(moment)).write.mode("append").parquet(staged)
    table = merges.history_table(spark, new_path(spark, "loans"), LOANS, "LoanID", BUCKETS)
    history = stream_scd2(
        spark, staged, LOANS_STAGING_TIMED, new_path(spark, "stream_checkpoint"), table, "LoanID", moment="arrived"
    )
    return times_as_text(history)


# Countries

def country_risk_category(spark: SparkSession, sf: str) -> DataFrame:
    return cty.country_risk_category(_landed_countries(spark, sf)).select(
        F.col("name.common").alias("country"), "region", "population", "risk_level"
    )


def currency_details(spark: SparkSession, sf: str) -> DataFrame:
    return cty.currency_details(_landed_countries(spark, sf))


def largest_country_per_region(spark: SparkSession, sf: str) -> DataFrame:
    return cty.largest_country_per_region(_landed_countries(spark, sf))


def rank_in_partition(spark: SparkSession, sf: str) -> DataFrame:
    rows = _landed_countries(spark, sf).select("region", F.col("name.common").alias("country"), "population")
    return ranking.rank_in_group(rows, "region", "population")


def limit_peek(spark: SparkSession, sf: str) -> DataFrame:
    return country_risk_category(spark, sf).orderBy("country").limit(10)


def _payloads(spark: SparkSession, sf: str) -> DataFrame:
    """One payload per currency, each with the countries that use it, as the landed files have them."""
    root = new_path(spark, "payloads")
    countries = fx.countries(spark, sf)
    # One write per payload: a partitioned write sorts the rows of each task, and nested rows are far wider than their file.
    for code, _, _ in fx.CURRENCIES:
        countries.filter(F.map_contains_key("currencies", code)).write.json(f"{root}/payload={code}")
    return cty.union_payloads([
        read_nested_json(spark, f"{root}/payload={code}", COUNTRIES, multi_line=False) for code, _, _ in fx.CURRENCIES
    ])


def union_payloads(spark: SparkSession, sf: str) -> DataFrame:
    return _payloads(spark, sf).select(F.col("name.common").alias("common"), "region", "population")


def union_payloads_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return cty.distinct_countries(_payloads(spark, sf)).select(
        F.col("name.common").alias("common"), "region", "population"
    )


def payload_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Landed payloads of which some are error bodies and some have a text as population: how many were taken, and how many
    lie in quarantine for which reason."""
    path, quarantine = new_path(spark, "landed"), new_path(spark, "quarantine")
    number = F.regexp_extract("name.common", "([0-9]+)$", 1).cast("long")
    good = F.to_json(F.struct(*[f.name for f in COUNTRIES.fields]))
    fx.countries(spark, sf).select(
        F.when(number % 11 == 0, F.lit('{"status": "404", "message": "not found"}'))
        .when(number % 13 == 0, F.lit('{"name": {"common": "Text"}, "region": "Asia", "population": "many"}'))
        .otherwise(good)
    ).write.text(path)
    taken = load_payloads(spark, path, COUNTRIES, ["name.common", "region"], quarantine, multi_line=False)
    outcomes = taken.select(F.lit("accepted").alias("outcome")).unionByName(
        spark.read.parquet(quarantine).select(F.col("reason").alias("outcome")))
    return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("payloads"))


def report_tables(spark: SparkSession, sf: str) -> DataFrame:
    """All reports, published as tables and read back."""
    root = new_path(spark, "reports")
    inputs = _sources(spark, sf) | {"countries": fx.countries(spark, sf)}
    publish.publish_reports(spark, root, inputs, fx.AS_OF, "day 1")
    return publish.published_counts(spark, root)


def _over(operator: Callable[..., DataFrame], *tables: Callable[[SparkSession, str], DataFrame], **options) -> Query:
    """A query that only hands whole tables to an operator."""
    return lambda spark, sf: operator(*[table(spark, sf) for table in tables], **options)


QUERIES: dict[str, Query] = {
    # scans, sources, sinks
    "scan_bounds": scan_bounds,
    "scan_csv_staging": scan_csv_staging,
    "scan_json_staging": scan_json_staging,
    "scan_nested_json": scan_nested_json,
    "sink_append": sink_append,
    "sink_overwrite": sink_overwrite,
    # incremental loads
    "load_full": load_full,
    "load_incremental": load_incremental,
    "load_incremental_overlap": load_incremental_overlap,
    "load_incremental_empty": load_incremental_empty,
    "raw_day_range": raw_day_range,
    "load_all_tables": load_all_tables,
    "load_audit": load_audit,
    "watermark_max": watermark_max,
    # filters and derived columns
    "overdraft_usage": _over(acc.overdraft_usage, fx.accounts),
    "high_value_foreign_payments": _over(acc.high_value_foreign_payments, fx.payments),
    "recent_low_balance_accounts": _over(acc.recent_low_balance_accounts, fx.accounts, as_of=fx.AS_OF),
    "failed_transactions": _over(acc.failed_transactions, fx.transactions),
    "excessive_fee_payments": _over(acc.excessive_fee_payments, fx.payments),
    "suspicious_transactions": _over(acc.suspicious_transactions, fx.transactions),
    "very_high_payments": _over(acc.very_high_payments, fx.payments),
    "low_credit_accounts": _over(acc.low_credit_accounts, fx.accounts),
    "filter_in_keys": lambda spark, sf: fx.accounts(spark, sf).filter(F.col("Currency").isin("GBP", "EUR")),
    "spot_check_customers": lambda spark, sf: fx.customer_target(spark, sf)
    .filter(F.col("CustomerID").isin(*SPOT_CHECK_CUSTOMERS)).drop("last_update"),
    "scalar_dates": scalar_dates,
    "scalar_casts": scalar_casts,
    "scalar_conditionals": scalar_conditionals,
    # joins
    "join_left_or_keys": _over(joins.accounts_with_payments, fx.accounts, fx.payments),
    "join_left_cast_key": _over(joins.accounts_with_transactions, fx.accounts, fx.transactions),
    "join_left_equi": lambda spark, sf: joins.accounts_with_flag(
        fx.accounts(spark, sf), acc.overdraft_usage(fx.accounts(spark, sf)), "ODUtilizationPercent"
    ),
    "join_left_chain": _over(joins.payments_with_derived, fx.payments),
    "join_full_outer_chain": lambda spark, sf: joins.full_outer_chain(
        acc.suspicious_transactions(fx.transactions(spark, sf)), acc.very_high_payments(fx.payments(spark, sf)),
        acc.low_credit_accounts(fx.accounts(spark, sf)),
    ),
    "join_lookup_broadcast": lambda spark, sf: joins.accounts_with_rates(
        fx.accounts(spark, sf), risk.exchange_rates(spark)
    ),
    "join_id_prefix": _over(prefix.prefix_pair_counts, fx.accounts, fx.transactions),
    # groupings
    "merchant_payment_summary": _over(acc.merchant_payment_summary, fx.payments),
    "customer_segment_transactions": _over(acc.customer_segment_transactions, fx.payments),
    "monthly_failed_transactions": _over(acc.monthly_failed_transactions, fx.transactions),
    "activity_heatmap": _over(acc.activity_heatmap, fx.transactions),
    "activity_heatmap_anomaly": _over(acc.activity_heatmap_anomaly, fx.transactions),
    "fee_leakage": _over(acc.fee_leakage, fx.transactions),
    # composite reports
    "ledger_flattened": _over(ledger.ledger_flattened, fx.accounts, fx.payments, fx.transactions, as_of=fx.AS_OF),
    "potential_fraud_accounts": _over(fraud.potential_fraud_accounts, fx.accounts, fx.transactions, fx.payments),
    "potential_fraud_accounts_coalesced": _over(
        fraud.potential_fraud_accounts_coalesced, fx.accounts, fx.transactions, fx.payments
    ),
    "payment_reconciliation": _over(reconciliation.payment_reconciliation, fx.payments),
    "portfolio_risk": lambda spark, sf: risk.portfolio_risk(fx.accounts(spark, sf), risk.exchange_rates(spark)),
    "customer_profitability": _over(prefix.customer_profitability, fx.accounts, fx.transactions),
    "customer_profitability_exact": _over(prefix.customer_profitability_exact, fx.accounts, fx.transactions),
    "cross_sell_opportunities": _over(prefix.cross_sell_opportunities, fx.accounts, fx.transactions),
    "clearing_system_efficiency": _over(prefix.clearing_system_efficiency, fx.payments, fx.transactions),
    "clearing_system_efficiency_monthly": _over(
        prefix.clearing_system_efficiency_monthly, fx.payments, fx.transactions
    ),
    # countries
    "country_risk_category": country_risk_category,
    "currency_details": currency_details,
    "largest_country_per_region": largest_country_per_region,
    "rank_in_partition": rank_in_partition,
    "limit_peek": limit_peek,
    "union_payloads": union_payloads,
    "union_payloads_dedup": union_payloads_dedup,
    "payload_quarantine": payload_quarantine,
    "report_tables": report_tables,
    # slowly changing dimensions
    "scd1_customer": scd1_customer,
    "scd1_customer_day2": scd1_customer_day2,
    "scd1_inserts_only": scd1_inserts_only,
    "scd1_branch": scd1_branch,
    "scd2_close": scd2_close,
    "scd2_loans_literal": scd2_loans_literal,
    "scd2_loans": scd2_loans,
    "scd2_current": scd2_current,
    "scd2_as_of": scd2_as_of,
    "staging_dedup": staging_dedup,
    "scd_audit": scd_audit,
    "stream_scd1_available_now": stream_scd1_available_now,
    "stream_scd2_available_now": stream_scd2_available_now,
}
