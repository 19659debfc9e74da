"""Reports that join on the first three characters of an id.

Such a join is many-to-many: each prefix pairs all its rows on one side with all on the other. Sums, counts, minima and
maxima over the pairs follow from the same figures per side, so each side is grouped first and the pairs are never made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankflow.functions import EXACT, EXACT_FACTOR, EXACT_PER_ROW, id_prefix, parse_day, ratio, year_month
from bankflow.plans import materialize
from bankflow.schemas import (
    CLEARING_SYSTEM_EFFICIENCY,
    CROSS_SELL_OPPORTUNITIES,
    CUSTOMER_PROFITABILITY,
    conform,
)

OD_CHARGE = 0.02
FIXED_COST = 1000
MIN_AVG_BALANCE = 50_000
MIN_HIGH_VALUE_COUNT = 3
HIGH_VALUE = 10_000

def _times(value: Column, rows: str) -> Column:
    """``value`` added ``rows`` times, without rounding."""
    return value.cast(EXACT_PER_ROW) * F.col(rows).cast(EXACT_FACTOR)


def _transactions_per_prefix(transactions: DataFrame) -> DataFrame:
    return (
        transactions.withColumn("_prefix", id_prefix(F.col("AccountID")))
        .groupBy("_prefix")
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.count("TransactionFee").alias("_fee_rows"),
            F.sum(F.col("TransactionFee").cast(EXACT)).alias("_fees"),
            F.count_if(F.col("Amount") > HIGH_VALUE).alias("_high"),
        )
    )


def _accounts_with_prefix_totals(accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    """Accounts with the totals of all transactions of their prefix, whatever its characters.

    The totals are written first: the optimizer broadcasts them if they are small, so accounts are then not shuffled.
    """
    keyed = accounts.withColumn("_prefix", id_prefix(F.col("AccountID")))
    return keyed.join(materialize(_transactions_per_prefix(transactions), "prefix_totals"), "_prefix")


def _profitability(totals: DataFrame) -> DataFrame:
    profit = F.col("TotalTransactionFees") + F.col("ODUtilizationPercent") * OD_CHARGE - FIXED_COST
    return conform(totals.withColumn("Profitability", profit), CUSTOMER_PROFITABILITY)


def _od_share() -> Column:
    return ratio(F.col("ODLimit") - F.col("Balance"), F.col("ODLimit"))


def customer_profitability(accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    """Balances, fees and overdraft use per customer over all account and transaction pairs of equal prefix."""
    totals = (
        _accounts_with_prefix_totals(accounts, transactions).groupBy("CustomerID")
        .agg(
            F.sum(_times(F.col("Balance"), "_rows")).cast("double").alias("AccountBalances"),
            F.sum("_fees").cast("double").alias("TotalTransactionFees"),
            (
                ratio(
                    F.sum(_times(_od_share(), "_rows")).cast("double"),
                    F.sum(F.when(_od_share().isNotNull(), F.col("_rows"))),
                ) * 100
            ).alias("ODUtilizationPercent"),
        )
    )
    return _profitability(totals)


def customer_profitability_exact(accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    """The same report with transactions of the account itself. They are grouped per account before the join."""
    per_account = transactions.groupBy(F.col("AccountID").alias("_account")).agg(
        F.count(F.lit(1)).alias("_rows"), F.sum(F.col("TransactionFee").cast(EXACT)).alias("_fees")
    )
    joined = accounts.withColumn("_account", F.col("AccountID").cast("string")).join(per_account, "_account")
    totals = joined.groupBy("CustomerID").agg(
        F.sum(_times(F.col("Balance"), "_rows")).cast("double").alias("AccountBalances"),
        F.sum("_fees").cast("double").alias("TotalTransactionFees"),
        (
            ratio(
                F.sum(_times(_od_share(), "_rows")).cast("double"),
                F.sum(F.when(_od_share().isNotNull(), F.col("_rows"))),
            ) * 100
        ).alias("ODUtilizationPercent"),
    )
    return _profitability(totals)


def cross_sell_opportunities(accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    totals = (
        _accounts_with_prefix_totals(accounts, transactions).groupBy("CustomerID")
        .agg(
            ratio(
                F.sum(_times(F.col("Balance"), "_rows")).cast("double"),
                F.sum(F.when(F.col("Balance").isNotNull(), F.col("_rows"))),
            ).alias("AvgAccountBalance"),
            F.sum("_high").alias("HighValueTransactionsCount"),
        )
    )
    eligible = (F.col("AvgAccountBalance") > MIN_AVG_BALANCE) & (
        F.col("HighValueTransactionsCount") >= MIN_HIGH_VALUE_COUNT
    )
    return conform(
        totals.withColumn("Eligibility", F.when(eligible, "Eligible").otherwise("Not Eligible")),
        CROSS_SELL_OPPORTUNITIES,
    )


def _day_number(day: Column) -> Column:
    return F.unix_date(day).cast("long")


def _clearing(payments: DataFrame, transactions: DataFrame, extra: list[str]) -> DataFrame:
    paid, traded = _day_number(F.col("PaymentDate")), _day_number(parse_day(F.col("TransactionDate")))
    left = (
        payments.withColumn("_day", paid)
        .groupBy(id_prefix(F.col("PaymentID")).alias("_prefix"), "ClearingSystem")
        .agg(
            F.count("_day").alias("_pn"), F.sum("_day").alias("_psum"),
            F.min("_day").alias("_pmin"), F.max("_day").alias("_pmax"),
        )
    )
    right = (
        transactions.withColumn("_day", traded)
        .withColumn("Month", year_month(parse_day(F.col("TransactionDate"))))
        .groupBy(id_prefix(F.col("TransactionID")).alias("_prefix"), *extra)
        .agg(
            F.count("_day").alias("_tn"), F.sum("_day").alias("_tsum"),
            F.min("_day").alias("_tmin"), F.max("_day").alias("_tmax"),
        )
    )

    def wide(name: str, rows: str) -> Column:
        return F.col(name).cast("decimal(19,0)") * F.col(rows).cast("decimal(18,0)")

    gap_sum = F.sum(wide("_tsum", "_pn") - wide("_psum", "_tn")).cast("double")
    pairs = F.sum(wide("_tn", "_pn")).cast("double")
    return left.join(right, "_prefix").groupBy("ClearingSystem", *extra).agg(
        F.abs(ratio(gap_sum, pairs)).alias("AvgProcessingTimeDays"),
        F.max(F.col("_tmax") - F.col("_pmin")).alias("MaxProcessingTimeDays"),
        F.min(F.col("_tmin") - F.col("_pmax")).alias("MinProcessingTimeDays"),
    )


def clearing_system_efficiency(payments: DataFrame, transactions: DataFrame) -> DataFrame:
    """Day gap between transaction and payment by clearing system; only the mean is made absolute."""
    return conform(_clearing(payments, transactions, []), CLEARING_SYSTEM_EFFICIENCY)


def clearing_system_efficiency_monthly(payments: DataFrame, transactions: DataFrame) -> DataFrame:
    """The report by clearing system and month of the transaction."""
    return _clearing(payments, transactions, ["Month"])


def prefix_pair_counts(accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    """Size of the prefix join per prefix, from the two sides' counts."""
    left = accounts.groupBy(id_prefix(F.col("AccountID")).alias("Prefix")).agg(F.count(F.lit(1)).alias("AccountRows"))
    right = transactions.groupBy(id_prefix(F.col("AccountID")).alias("Prefix")).agg(
        F.count(F.lit(1)).alias("TransactionRows")
    )
    return left.join(right, "Prefix").withColumn("JoinedPairs", F.col("AccountRows") * F.col("TransactionRows"))
