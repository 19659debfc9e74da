"""The join shapes of the ledger and of the fraud report, as operators of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankflow.functions import EXACT, ratio
from bankflow.operators.accounts import excessive_fee_payments
from bankflow.plans import DEFAULT_CHUNK, fan_out_left, left_join, materialize, split_layout
from bankflow.plans.skew import BASE

ACCOUNT_KEY = "AccountKey"


def with_account_key(accounts: DataFrame) -> DataFrame:
    """Account ids are integers here and text in transactions and payments; cast once, before the join."""
    return accounts.withColumn(ACCOUNT_KEY, F.col("AccountID").cast("string"))


def payments_by_account(payments: DataFrame) -> DataFrame:
    """A payment once per account it touches.

    ``id = From OR id = To`` has no hash key and would be a nested loop. One row per distinct end, joined by equality,
    gives the same matches; a payment to oneself stays one row.
    """
    ends = F.array_distinct(F.array("FromAccountID", "ToAccountID"))
    return payments.withColumn(ACCOUNT_KEY, F.explode(ends)).filter(F.col(ACCOUNT_KEY).isNotNull())


def accounts_with_payments(accounts: DataFrame, payments: DataFrame, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """LEFT JOIN on either end of the payment."""
    left = with_account_key(accounts).select(ACCOUNT_KEY, "AccountID", "Balance")
    right = payments_by_account(payments).select(
        ACCOUNT_KEY, "PaymentID", "FromAccountID", "ToAccountID", F.col("Amount").alias("PaymentAmount")
    )
    joined = left_join(left, right, ACCOUNT_KEY, chunk, F.monotonically_increasing_id())
    return joined.drop(ACCOUNT_KEY)


def accounts_with_transactions(accounts: DataFrame, transactions: DataFrame, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """LEFT JOIN with a cast key."""
    left = with_account_key(accounts).select(ACCOUNT_KEY, "AccountID", "Currency")
    right = transactions.select(
        F.col("AccountID").alias(ACCOUNT_KEY), "TransactionID", F.col("Amount").alias("TransactionAmount"), "Status"
    )
    joined = left_join(left, right, ACCOUNT_KEY, chunk, F.monotonically_increasing_id())
    return joined.drop(ACCOUNT_KEY)


def accounts_with_flag(accounts: DataFrame, flagged: DataFrame, column: str, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """LEFT JOIN of accounts with a per-account derived table on the native key."""
    left = accounts.select("AccountID", "AccountType", "CreditScore")
    return left_join(left, flagged.select("AccountID", column), "AccountID", chunk, F.monotonically_increasing_id())


def payment_summaries(payments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Merchant and segment totals from one pass over the payments.

    The totals per merchant and segment are written; both results are groupings of that table. The few segments are
    written on their own, so that their join knows their size and does not shuffle all payments by a segment.
    """
    amount = F.col("Amount")
    totals = materialize(
        payments.groupBy("MerchantName", "CustomerSegment").agg(
            F.sum(amount.cast(EXACT)).alias("_sum"), F.count(amount).alias("_amounts"),
            F.max(amount).alias("_max"), F.min(amount).alias("_min"), F.count(F.lit(1)).alias("_rows"),
        ),
        "payment_totals",
    )
    total = F.sum("_sum").cast("double")
    average = ratio(total, F.sum("_amounts"))
    merchants = totals.groupBy("MerchantName").agg(
        total.alias("MerchantTotalPayments"),
        average.alias("MerchantAvgPaymentAmount"),
        F.max("_max").alias("MerchantMaxPaymentAmount"),
        F.min("_min").alias("MerchantMinPaymentAmount"),
        F.sum("_rows").alias("MerchantTotalTransactions"),
    )
    segments = totals.groupBy("CustomerSegment").agg(
        F.sum("_rows").alias("SegmentTotalTransactions"),
        total.alias("SegmentTotalAmount"),
        average.alias("SegmentAvgTransactionAmount"),
    )
    return merchants, materialize(segments, "segment_totals")


def payments_with_derived(payments: DataFrame, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """Payments with the fee check, merchant totals and segment totals, each a LEFT JOIN from a payment column."""
    merchants, segments = payment_summaries(payments)
    rows = payments.select("PaymentID", "Amount", "MerchantName", "CustomerSegment")
    fees = excessive_fee_payments(payments).select("PaymentID", "ExcessiveFeePercent")
    with_fees = left_join(rows, fees, "PaymentID", chunk, F.monotonically_increasing_id())
    return with_fees.join(merchants, "MerchantName", "left").join(segments, "CustomerSegment", "left")


def distinct_with_count(df: DataFrame, count: str) -> DataFrame:
    """Copies of a row as one row and a number; combined before the shuffle."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(count))


def full_outer_parts(
    first: DataFrame, second: DataFrame, third: DataFrame, key: str, chunk: int
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame | None]:
    """``first FULL JOIN second ON first.key = second.key FULL JOIN third ON first.key = third.key`` in three parts.

    The parts are the rows that have a ``first`` row, the ``second`` rows without one and the ``third`` rows without one.
    Both conditions read the key of ``first``, so the last two never meet each other. A full outer join cannot be split
    at a hot key; the left joins and anti joins here can. Rows must be distinct within each input, and the inputs written,
    as each is read several times. The layout of the split keys is returned as well.
    """
    # Rows without a key meet nothing. Kept apart, they do not all travel to the one partition of NULL.
    keyed, unkeyed = first.filter(F.col(key).isNotNull()), first.filter(F.col(key).isNull())
    factors = split_layout({BASE: keyed, "second": second, "third": third}, key, chunk)
    matched = fan_out_left(keyed, {"second": second, "third": third}, key, factors)
    matched = matched.unionByName(unkeyed, allowMissingColumns=True)
    first_keys = keyed.select(key).distinct()
    return matched, second.join(first_keys, key, "left_anti"), third.join(first_keys, key, "left_anti"), factors


def repeat_rows(df: DataFrame, times: str, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """Back from one row and a number to that many copies. A row with more than ``chunk`` of them is first cut into
    pieces, which are dealt out before they are repeated."""
    number, one = F.col(times), F.lit(1).cast("long")
    # A number of tasks, as adaptive execution would join pieces, which are few bytes before they are repeated.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = F.sequence(F.lit(0).cast("long"), F.floor((number - 1) / chunk))
    few = df.filter(number <= chunk)
    many = (
        df.filter(number > chunk).withColumn("_piece", F.explode(pieces))
        .withColumn(times, F.least(number - F.col("_piece") * chunk, F.lit(chunk).cast("long"))).drop("_piece")
        .repartition(tasks)
    )
    return few.unionByName(many).withColumn("_copy", F.explode(F.sequence(one, number))).drop("_copy", times)


def full_outer_chain(
    transactions: DataFrame, payments: DataFrame, accounts: DataFrame, chunk: int = DEFAULT_CHUNK
) -> DataFrame:
    """The chain of two full joins as rows: suspicious transactions, very high payments, low scores."""
    key = ACCOUNT_KEY
    inputs = [
        transactions.withColumnRenamed("AccountID", key),
        payments.withColumnRenamed("AccountID", key),
        accounts.select(F.col("AccountID").cast("string").alias(key), "CreditScore"),
    ]
    counted = [materialize(distinct_with_count(df, f"_n{n}"), "signs") for n, df in enumerate(inputs, 1)]
    matched, only_second, only_third, _ = full_outer_parts(*counted, key, chunk)
    columns = {
        "AccountID": "string", "TransactionID": "bigint", "Suspicious": "boolean", "PaymentAccountID": "string",
        "PaymentID": "bigint", "ScoreAccountID": "string", "CreditScore": "bigint",
    }
    one = F.lit(1).cast("long")
    matched = matched.select(
        F.col(key).alias("AccountID"), "TransactionID", "Suspicious",
        F.when(F.col("_n2").isNotNull(), F.col(key)).alias("PaymentAccountID"), "PaymentID",
        F.when(F.col("_n3").isNotNull(), F.col(key)).alias("ScoreAccountID"), "CreditScore",
        (F.col("_n1") * F.coalesce("_n2", one) * F.coalesce("_n3", one)).alias("_times"),
    )
    only_second = only_second.select(
        F.col(key).alias("PaymentAccountID"), "PaymentID", F.col("_n2").alias("_times")
    )
    only_third = only_third.select(F.col(key).alias("ScoreAccountID"), "CreditScore", F.col("_n3").alias("_times"))
    rows = matched.unionByName(only_second, allowMissingColumns=True).unionByName(only_third, allowMissingColumns=True)
    return repeat_rows(rows, "_times", chunk).select(*[F.col(c).cast(t).alias(c) for c, t in columns.items()])


def accounts_with_rates(accounts: DataFrame, rates: DataFrame) -> DataFrame:
    """Inner lookup join. No hint: the optimizer knows the size of ``rates`` when they are literal rows or a written table,
    broadcasts them when that is small and shuffles beyond."""
    return accounts.select("AccountID", "CustomerID", "Balance", "Currency").join(rates, "Currency")
