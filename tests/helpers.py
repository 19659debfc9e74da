"""Comparison of results and random bank tables small enough for brute force."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import DataFrame, SparkSession

from bankflow.plans import materialize

ACCOUNTS = (
    "AccountID bigint, CustomerID bigint, AccountType string, Balance double, ODLimit double, CreditScore bigint, "
    "Currency string, DateOpened date, ManagerID bigint"
)
TRANSACTIONS = (
    "TransactionID bigint, AccountID string, Amount double, Currency string, Status string, TransactionType string, "
    "EventTs string, TransactionDate string, TransactionFee double, Suspecious boolean, Description string"
)
PAYMENTS = (
    "PaymentID bigint, FromAccountID string, ToAccountID string, Amount double, Currency string, ExchangeRate double, "
    "PaymentDate date, MerchantName string, Description string, ClearingSystem string, CustomerSegment string, "
    "PaymentType string, Fee double"
)


def rows(df: DataFrame) -> list[tuple]:
    """Rows in an order of their own, with columns in name order."""
    columns = sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def assert_same(left: DataFrame, right: DataFrame) -> None:
    assert sorted(left.columns) == sorted(right.columns)
    assert rows(left) == rows(right)


def bank(spark: SparkSession, seed: int) -> dict[str, DataFrame]:
    """Few accounts, one of them in a third of all rows; with copies, NULLs, zero divisors and repeated ids."""
    rng = random.Random(seed)

    def maybe(value, share=0.1):
        return None if rng.random() < share else value

    def account() -> int:
        return 1 if rng.random() < 0.35 else rng.randint(2, 9)

    def day() -> dt.date:
        return dt.date(2001, rng.randint(1, 7), rng.randint(1, 28))

    accounts = [
        (maybe(i, 0.05), i // 3, rng.choice(["Savings", "Current"]), rng.choice([-50.5, 10.5, 900.0, 60000.0]),
         rng.choice([0.0, 100.0, 2000.0]), rng.choice([350, 390, 700]), rng.choice(["USD", "EUR", "GBP"]),
         maybe(dt.date(2000, rng.randint(1, 12), 5)), 7)
        for i in [1, *range(1, 10)]
    ]
    transactions = []
    for i in range(14):
        d = day().strftime("%d-%m-%Y")
        transactions.append((
            maybe(i // 2), maybe(str(account()), 0.05), rng.choice([50.0, 12000.0, 200000.0]), "USD",
            rng.choice(["Failed", "Failed", "Success"]), rng.choice(["Debit", "Credit"]), f"{d} 0{i % 9}:15", d,
            rng.choice([None, 0.0, 30.5]), rng.choice([True, False, None]), rng.choice(["a", "b"]),
        ))
    transactions += transactions[:3]
    payments = [
        (rng.choice([1, 1, 2, 3, 12]), maybe(str(account()), 0.05), maybe(str(account()), 0.05),
         rng.choice([0.0, 100.0, 101.0, 20000.0, 150000.0]), rng.choice(["USD", "EUR", None]), rng.choice([1.0, 1.1]),
         day(), rng.choice(["M1", "M2", None]), rng.choice(["x", "y"]), rng.choice(["SWIFT", "SEPA", "ACH", None]),
         rng.choice(["Retail", "Corporate", None]), "Wire", rng.choice([0.0, 5.0, 90.0, 20000.0]))
        for _ in range(12)
    ]
    payments += payments[:3]
    tables = {
        "accounts": materialize(spark.createDataFrame(accounts, ACCOUNTS).coalesce(1), "accounts"),
        "transactions": materialize(spark.createDataFrame(transactions, TRANSACTIONS).coalesce(1), "transactions"),
        "payments": materialize(spark.createDataFrame(payments, PAYMENTS).coalesce(1), "payments"),
    }
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return tables
