"""Joins in split form over the fixture tables with a few busy keys: the same rows as unsplit, spread over tasks."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from bankflow import fixtures as fx
from bankflow.operators import fraud, joins, ledger, reconciliation
from bankflow.operators.accounts import low_credit_accounts, suspicious_transactions, very_high_payments
from bankflow.plans import materialize

SF_DIR = "/root/testdata/sf0.001"
SMALL, WHOLE = 300, 10**15


@pytest.fixture(scope="module")
def skewed(spark):
    """One account, in overdraft, holds every hundredth transaction and every two hundredth payment; one payment id every
    hundredth payment."""
    busy = "11"
    accounts = fx.accounts(spark, SF_DIR)
    accounts = accounts.withColumn("Balance", F.when(F.col("AccountID") == 11, -5.0).otherwise(F.col("Balance"))).withColumn(
        "ODLimit", F.when(F.col("AccountID") == 11, 100.0).otherwise(F.col("ODLimit")))
    transactions = fx.transactions(spark, SF_DIR).withColumn(
        "AccountID", F.when(F.col("TransactionID") % 100 == 0, busy).otherwise(F.col("AccountID")))
    number = F.xxhash64("PaymentID", "Amount", "PaymentDate", "MerchantName")
    payments = fx.payments(spark, SF_DIR).withColumn("_n", F.pmod(number, F.lit(200))).withColumn(
        "FromAccountID", F.when(F.col("_n") == 0, busy).otherwise(F.col("FromAccountID"))).withColumn(
        "PaymentID", F.when(F.col("_n") < 2, F.lit(77)).otherwise(F.col("PaymentID"))).drop("_n")
    return {n: materialize(df, n) for n, df in (
        ("accounts", accounts), ("transactions", transactions), ("payments", payments))}


def summary(df):
    return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()


FORMS = {
    "ledger": lambda t, chunk: ledger.ledger_flattened(t["accounts"], t["payments"], t["transactions"], fx.AS_OF, chunk),
    "fraud": lambda t, chunk: fraud.potential_fraud_accounts(t["accounts"], t["transactions"], t["payments"], chunk),
    "fraud_coalesced": lambda t, chunk: fraud.potential_fraud_accounts_coalesced(
        t["accounts"], t["transactions"], t["payments"], chunk),
    "reconciliation": lambda t, chunk: reconciliation.payment_reconciliation(t["payments"], chunk),
    "either_end": lambda t, chunk: joins.accounts_with_payments(t["accounts"], t["payments"], chunk),
    "chain": lambda t, chunk: joins.payments_with_derived(t["payments"], chunk),
    "full_outer": lambda t, chunk: joins.full_outer_chain(
        suspicious_transactions(t["transactions"]), very_high_payments(t["payments"]), low_credit_accounts(t["accounts"]),
        chunk),
}


@pytest.mark.parametrize("form", sorted(FORMS))
def test_split_form_gives_the_same_rows(spark, skewed, form):
    whole, split = (summary(FORMS[form](skewed, chunk)) for chunk in (WHOLE, SMALL))
    assert whole == split and whole[0] > 0


def test_ledger_of_a_busy_account_is_spread(spark, skewed):
    """Its product has most of all rows; no task has half of them."""
    settings = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false",
                "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        rows = FORMS["ledger"](skewed, SMALL)
        tasks = rows.groupBy(F.spark_partition_id().alias("task")).agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("AccountID") == 11).alias("busy")).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    busy, total = sum(r.busy for r in tasks), sum(r.n for r in tasks)
    assert busy > total / 3 and max(r.n for r in tasks) < total / 3
