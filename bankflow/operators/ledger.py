"""The flattened account ledger."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankflow.operators.accounts import (
    amount_usd,
    excessive_fee_payments,
    failed_transactions,
    is_high_value_foreign,
    monthly_failed_transactions,
    overdraft_usage,
    recent_low_balance_accounts,
)
from bankflow.operators.joins import ACCOUNT_KEY, payment_summaries, payments_by_account, with_account_key
from bankflow.plans import DEFAULT_CHUNK, fan_out_left, layout_of, materialize, split_layout
from bankflow.plans.skew import BASE

# Output columns in order.
LEDGER_COLUMNS = [
    "AccountID", "AccountType", "Balance", "AccountCurrency", "CreditScore", "DateOpened", "ManagerID", "ODLimit",
    "ODUtilizationPercent",
    "HighValuePaymentAmount", "HighValuePaymentDate", "HighValueMerchant", "HighValuePaymentDescription",
    "RecentLowBalance",
    "FailedTransactionID", "FailedTransactionAmount", "FailedTransactionCurrency", "FailedTransactionStatus",
    "FailedTransactionEventTs", "FailedTransactionDescription",
    "ExcessiveFeePercent",
    "MerchantTotalPayments", "MerchantAvgPaymentAmount", "MerchantMaxPaymentAmount", "MerchantMinPaymentAmount",
    "MerchantTotalTransactions",
    "SegmentTotalTransactions", "SegmentTotalAmount", "SegmentAvgTransactionAmount",
    "MonthlyFailedTransactionCount",
    "PaymentID", "FromAccountID", "ToAccountID", "PaymentAmount", "PaymentCurrency", "PaymentDate", "MerchantName",
    "PaymentDescription", "PaymentType", "PaymentFee",
    "TransactionID", "TransactionType", "TransactionAmount", "TransactionCurrency", "TransactionStatus",
    "TransactionEventTs", "TransactionDescription", "TransactionFee", "TransactionDate", "IsSuspicious",
]


def _accounts_in_overdraft(accounts: DataFrame, as_of: dt.date) -> DataFrame:
    """Accounts with a known overdraft share. Filtering on that share makes its left join an inner one."""
    keyed = with_account_key(accounts)
    rows = keyed.select(
        ACCOUNT_KEY, "AccountID", "AccountType", "Balance", F.col("Currency").alias("AccountCurrency"), "CreditScore",
        "DateOpened", "ManagerID", "ODLimit",
    ).distinct()
    used = (
        with_account_key(overdraft_usage(accounts)).select(ACCOUNT_KEY, "ODUtilizationPercent")
        .filter(F.col("ODUtilizationPercent").isNotNull()).distinct()
    )
    low = (
        with_account_key(recent_low_balance_accounts(accounts, as_of))
        .select(ACCOUNT_KEY, F.col("Balance").alias("RecentLowBalance")).distinct()
    )
    return rows.join(used, ACCOUNT_KEY).join(low, ACCOUNT_KEY, "left")


def ledger_flattened(
    accounts: DataFrame, payments: DataFrame, transactions: DataFrame, as_of: dt.date, chunk: int = DEFAULT_CHUNK
) -> DataFrame:
    """Accounts in overdraft with all combinations of their payments, transactions, failures and summaries.

    The result is distinct over 50 columns. Each input is made distinct on the columns that reach the output (the
    account and everything below it), and a product of distinct sets has no repeats, so the wide product itself needs no
    final DISTINCT and no shuffle after the joins.
    """
    base = materialize(_accounts_in_overdraft(accounts, as_of), "overdraft_accounts")
    keys = materialize(base.select(ACCOUNT_KEY).distinct(), "overdraft_keys")

    def of_base(df: DataFrame, name: str) -> DataFrame:
        """Rows of accounts in overdraft, written once for all their uses. The key table carries its size, by which the
        optimizer broadcasts or shuffles it."""
        return materialize(df.join(keys, ACCOUNT_KEY, "left_semi"), name)

    merchants, segments = payment_summaries(payments)
    touched = of_base(payments_by_account(payments), "overdraft_payments")
    traded = of_base(transactions.withColumn(ACCOUNT_KEY, F.col("AccountID")), "overdraft_transactions")

    # The segment is not in the output, so its figures replace it before the rows are made distinct.
    paid = (
        touched.join(segments, "CustomerSegment", "left")
        .select(
            ACCOUNT_KEY, "PaymentID", "FromAccountID", "ToAccountID", F.col("Amount").alias("PaymentAmount"),
            F.col("Currency").alias("PaymentCurrency"), "PaymentDate", "MerchantName",
            F.col("Description").alias("PaymentDescription"), "PaymentType", F.col("Fee").alias("PaymentFee"),
            "SegmentTotalTransactions", "SegmentTotalAmount", "SegmentAvgTransactionAmount",
        ).distinct()
    )
    high = touched.filter(is_high_value_foreign()).select(
        ACCOUNT_KEY, amount_usd().alias("HighValuePaymentAmount"), F.col("PaymentDate").alias("HighValuePaymentDate"),
        F.col("MerchantName").alias("HighValueMerchant"), F.col("Description").alias("HighValuePaymentDescription"),
    ).distinct()
    traded_rows = traded.select(
        ACCOUNT_KEY, "TransactionID", "TransactionType", F.col("Amount").alias("TransactionAmount"),
        F.col("Currency").alias("TransactionCurrency"), F.col("Status").alias("TransactionStatus"),
        F.col("EventTs").alias("TransactionEventTs"), F.col("Description").alias("TransactionDescription"),
        "TransactionFee", "TransactionDate", F.col("Suspecious").alias("IsSuspicious"),
    ).distinct()
    failed = failed_transactions(traded).select(
        F.col("AccountID").alias(ACCOUNT_KEY), F.col("TransactionID").alias("FailedTransactionID"),
        F.col("Amount").alias("FailedTransactionAmount"), F.col("Currency").alias("FailedTransactionCurrency"),
        F.col("Status").alias("FailedTransactionStatus"), F.col("EventTs").alias("FailedTransactionEventTs"),
        F.col("Description").alias("FailedTransactionDescription"),
    ).distinct()
    # Months with equal counts are equal in the output, which has no month.
    monthly = monthly_failed_transactions(traded).select(
        F.col("AccountID").alias(ACCOUNT_KEY), F.col("FailedTransactionCount").alias("MonthlyFailedTransactionCount")
    ).distinct()

    # The rows of an account before they are made distinct bound those after it. Its months are at most its failures.
    def of_kind(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, 1)), F.lit(0))

    any_row, failure = F.lit(True), F.col("Status") == "Failed"
    counts = (
        base.groupBy(ACCOUNT_KEY).agg(of_kind(any_row).alias(f"_n_{BASE}"))
        .join(touched.groupBy(ACCOUNT_KEY).agg(
            of_kind(any_row).alias("_n_paid"), of_kind(is_high_value_foreign()).alias("_n_high")), ACCOUNT_KEY, "left")
        .join(traded.groupBy(ACCOUNT_KEY).agg(
            of_kind(any_row).alias("_n_traded"), of_kind(failure).alias("_n_failed"),
            of_kind(failure).alias("_n_monthly")), ACCOUNT_KEY, "left")
        .na.fill(0)
    )
    factors = layout_of(counts, [BASE, "paid", "high", "traded", "failed", "monthly"], ACCOUNT_KEY, chunk)

    with_fees = _with_excessive_fees(paid, payments, chunk).join(merchants, "MerchantName", "left")
    joined = fan_out_left(
        base,
        {"high": high, "failed": failed, "monthly": monthly, "paid": with_fees, "traded": traded_rows},
        ACCOUNT_KEY,
        factors,
    )
    return joined.select(*LEDGER_COLUMNS)


def _with_excessive_fees(paid: DataFrame, payments: DataFrame, chunk: int) -> DataFrame:
    """Distinct fee shares of the same payment id. The id may repeat, so it gets the same care as the account; the rows of
    an id bound those of both inputs."""
    fees = excessive_fee_payments(payments).select("PaymentID", "ExcessiveFeePercent").distinct()
    factors = split_layout({BASE: payments, "fees": payments}, "PaymentID", chunk)
    return fan_out_left(paid, {"fees": fees}, "PaymentID", factors)
