"""Filters and groupings over accounts, transactions and payments."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bankflow.functions import (
    event_hour,
    event_weekday,
    exact_avg,
    exact_sum,
    parse_day,
    percent,
    ratio,
    year_month,
)
from bankflow.schemas import ACTIVITY_HEATMAP, FEE_LEAKAGE, conform

HIGH_VALUE = 10_000
VERY_HIGH_VALUE = 100_000
LOW_BALANCE = 1_000
LOW_SCORE = 400
EXCESSIVE_FEE_SHARE = 0.05
EXPECTED_FEE_SHARE = 0.01
LEAK_FEE_SHARE = 0.001


def amount_usd() -> Column:
    return F.col("Amount") * F.col("ExchangeRate")


def is_high_value_foreign() -> Column:
    return (amount_usd() > HIGH_VALUE) & (F.col("Currency") != "USD")


def overdraft_usage(accounts: DataFrame) -> DataFrame:
    """Accounts whose limit exceeds their balance, with the used share of the limit (NULL for a zero limit)."""
    return accounts.filter(F.col("ODLimit") > F.col("Balance")).select(
        "AccountID", "AccountType", "Balance", "ODLimit",
        percent(F.col("ODLimit") - F.col("Balance"), F.col("ODLimit")).alias("ODUtilizationPercent"),
    )


def high_value_foreign_payments(payments: DataFrame) -> DataFrame:
    return payments.filter(is_high_value_foreign()).select(
        "PaymentID", "FromAccountID", "ToAccountID", amount_usd().alias("AmountUSD"), "PaymentDate", "MerchantName",
        "Description",
    )


def recent_low_balance_accounts(accounts: DataFrame, as_of: dt.date) -> DataFrame:
    """Accounts opened within a year before ``as_of`` and holding little."""
    opened_since = F.add_months(F.lit(as_of), -12)
    return accounts.filter((F.col("DateOpened") >= opened_since) & (F.col("Balance") < LOW_BALANCE)).select(
        "AccountID", "AccountType", "Balance", "Currency", "DateOpened"
    )


def failed_transactions(transactions: DataFrame) -> DataFrame:
    return transactions.filter(F.col("Status") == "Failed").select(
        "TransactionID", "AccountID", "Amount", "Currency", "Status", "EventTs", "Description"
    )


def excessive_fee_payments(payments: DataFrame) -> DataFrame:
    fee_share = ratio(F.col("Fee"), F.col("Amount"))
    return payments.filter(fee_share > EXCESSIVE_FEE_SHARE).select(
        "PaymentID", "Amount", "Currency", "Fee", (fee_share * 100).alias("ExcessiveFeePercent"), "Description"
    )


def suspicious_transactions(transactions: DataFrame) -> DataFrame:
    return transactions.filter(F.col("Suspecious")).select(
        "AccountID", "TransactionID", F.col("Suspecious").alias("Suspicious")
    )


def very_high_payments(payments: DataFrame) -> DataFrame:
    return payments.filter(amount_usd() > VERY_HIGH_VALUE).select(F.col("FromAccountID").alias("AccountID"), "PaymentID")


def low_credit_accounts(accounts: DataFrame) -> DataFrame:
    return accounts.filter(F.col("CreditScore") < LOW_SCORE).select("AccountID", "CreditScore")


def merchant_payment_summary(payments: DataFrame) -> DataFrame:
    return payments.groupBy("MerchantName").agg(
        exact_sum(F.col("Amount")).alias("TotalPayments"),
        exact_avg(F.col("Amount")).alias("AvgPaymentAmount"),
        F.max("Amount").alias("MaxPaymentAmount"),
        F.min("Amount").alias("MinPaymentAmount"),
        F.count(F.lit(1)).alias("TotalTransactions"),
    )


def customer_segment_transactions(payments: DataFrame) -> DataFrame:
    return payments.groupBy("CustomerSegment").agg(
        F.count(F.lit(1)).alias("TotalTransactions"),
        exact_sum(F.col("Amount")).alias("TotalAmount"),
        exact_avg(F.col("Amount")).alias("AvgTransactionAmount"),
    )


def monthly_failed_transactions(transactions: DataFrame) -> DataFrame:
    failed = transactions.filter(F.col("Status") == "Failed")
    return failed.groupBy("AccountID", year_month(parse_day(F.col("TransactionDate"))).alias("YearMonth")).agg(
        F.count(F.lit(1)).alias("FailedTransactionCount")
    )


def activity_heatmap(transactions: DataFrame) -> DataFrame:
    cells = transactions.groupBy(
        "AccountID",
        event_weekday(F.col("EventTs")).alias("DayOfWeek"),
        event_hour(F.col("EventTs")).alias("HourOfDay"),
    ).agg(
        F.count(F.lit(1)).alias("TransactionCount"),
        exact_avg(F.col("Amount")).alias("AvgTransactionAmount"),
    )
    return conform(cells, ACTIVITY_HEATMAP)


def activity_heatmap_anomaly(transactions: DataFrame) -> DataFrame:
    """The heatmap with a flag for cells above the mean count of their account.

    The window runs over cells, of which an account has at most 7 weekdays x 100 two-digit hours.
    """
    account = Window.partitionBy("AccountID")
    return activity_heatmap(transactions).withColumn(
        "Anomaly",
        F.when(F.col("TransactionCount") > F.avg("TransactionCount").over(account), "High Activity")
        .otherwise("Normal Activity"),
    )


def fee_leakage(
    transactions: DataFrame, expected_share: float = EXPECTED_FEE_SHARE, leak_share: float = LEAK_FEE_SHARE
) -> DataFrame:
    rows = transactions.select(
        "TransactionID", "AccountID", "Amount", "TransactionFee",
        (F.col("Amount") * expected_share).alias("ExpectedFee"),
        F.when(F.col("TransactionFee") < F.col("Amount") * leak_share, "Potential Leak")
        .otherwise("Normal").alias("Status"),
    )
    return conform(rows, FEE_LEAKAGE)
