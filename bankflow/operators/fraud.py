"""Accounts with combined warning signs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankflow.operators.accounts import low_credit_accounts, suspicious_transactions, very_high_payments
from bankflow.operators.joins import distinct_with_count, full_outer_parts
from bankflow.plans import DEFAULT_CHUNK, fan_out_left, materialize
from bankflow.plans.skew import BASE
from bankflow.schemas import POTENTIAL_FRAUD_ACCOUNTS, conform

_KEY = "AccountKey"


def _signs(accounts: DataFrame, transactions: DataFrame, payments: DataFrame) -> list[DataFrame]:
    return [
        suspicious_transactions(transactions).withColumnRenamed("AccountID", _KEY),
        very_high_payments(payments).withColumnRenamed("AccountID", _KEY),
        low_credit_accounts(accounts).select(F.col("AccountID").cast("string").alias(_KEY), "CreditScore"),
    ]


def _counted(signs: list[DataFrame]) -> list[DataFrame]:
    """The signs with copies counted, written once for all their uses. Counting first makes every combination unique."""
    return [materialize(distinct_with_count(sign, f"_n{n}"), "signs") for n, sign in enumerate(signs, 1)]


def _events(*counts: str) -> Column:
    product = F.lit(1).cast("long")
    for count in counts:
        product = product * F.coalesce(F.col(count), F.lit(1).cast("long"))
    return product.alias("TotalFlaggedEvents")


def potential_fraud_accounts(
    accounts: DataFrame, transactions: DataFrame, payments: DataFrame, chunk: int = DEFAULT_CHUNK
) -> DataFrame:
    """Count of combinations of suspicious transaction, very high payment and low score.

    The account is that of the suspicious transaction: payments and scores of accounts without one appear with a NULL
    account and are grouped on what is left. Only those two parts need a second grouping.
    """
    signs = _counted(_signs(accounts, transactions, payments))
    matched, only_payment, only_score, _ = full_outer_parts(*signs, _KEY, chunk)
    matched = matched.select(
        F.col(_KEY).alias("AccountID"), "TransactionID", "PaymentID", "Suspicious", "CreditScore",
        _events("_n1", "_n2", "_n3"),
    )
    only_payment = only_payment.groupBy("PaymentID").agg(F.sum("_n2").alias("TotalFlaggedEvents"))
    only_score = only_score.groupBy("CreditScore").agg(F.sum("_n3").alias("TotalFlaggedEvents"))
    rows = (
        matched.unionByName(only_payment, allowMissingColumns=True)
        .unionByName(only_score, allowMissingColumns=True)
    )
    return conform(rows, POTENTIAL_FRAUD_ACCOUNTS)


def potential_fraud_accounts_coalesced(
    accounts: DataFrame, transactions: DataFrame, payments: DataFrame, chunk: int = DEFAULT_CHUNK
) -> DataFrame:
    """The same signs, keyed on whichever input names the account, so that no sign loses its account."""
    suspicious, high, low = _counted(_signs(accounts, transactions, payments))
    matched, only_payment, only_score, factors = full_outer_parts(suspicious, high, low, _KEY, chunk)
    if factors is not None:
        # Payments take the place of the first input in this join.
        factors = factors.select(_KEY, F.col("_k_second").alias(f"_k_{BASE}"), F.col("_k_third").alias("_k_low"))
    only_payment = fan_out_left(only_payment, {"low": low}, _KEY, factors)
    only_score = only_score.join(high.select(_KEY).distinct(), _KEY, "left_anti")
    rows = [
        part.select(F.col(_KEY).alias("AccountID"), *names, _events(*counts))
        for part, names, counts in (
            (matched, ["TransactionID", "PaymentID", "Suspicious", "CreditScore"], ["_n1", "_n2", "_n3"]),
            (only_payment, ["PaymentID", "CreditScore"], ["_n2", "_n3"]),
            (only_score, ["CreditScore"], ["_n3"]),
        )
    ]
    united = rows[0].unionByName(rows[1], allowMissingColumns=True).unionByName(rows[2], allowMissingColumns=True)
    return conform(united, POTENTIAL_FRAUD_ACCOUNTS)
