from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from bankflow.functions import (
    day_gap,
    event_hour,
    event_weekday,
    exact_avg,
    exact_sum,
    id_prefix,
    parse_day,
    percent,
    ratio,
    to_int64,
)
from bankflow.operators import accounts as acc
from bankflow.operators import prefix, risk
from tests.helpers import assert_same, bank


def one(spark, expression):
    return spark.range(1).select(expression.alias("v")).first().v


@pytest.mark.parametrize("value, expected", [(2.5, 3), (-2.5, -3), (0.5, 1), (1.4999, 1), (-0.5, -1), (None, None)])
def test_to_int64_rounds_halves_away_from_zero(spark, value, expected):
    assert one(spark, to_int64(F.lit(value).cast("double"))) == expected


def test_zero_divisor_is_null(spark):
    assert one(spark, ratio(F.lit(1.0), F.lit(0.0))) is None
    assert one(spark, percent(F.lit(1.0), F.lit(4.0))) == 25.0


def test_parse_day(spark):
    assert one(spark, parse_day(F.lit("31-01-2024"))) == dt.date(2024, 1, 31)
    assert one(spark, parse_day(F.lit("31-02-2024"), on_bad="null")) is None
    assert one(spark, parse_day(F.lit("3-1-2024"), on_bad="null")) is None
    with pytest.raises(Exception, match="31-02-2024|parse|date"):
        one(spark, parse_day(F.lit("31-02-2024")))


def test_event_parts(spark):
    sunday = F.lit("07-01-2024 14:33")
    assert one(spark, event_weekday(sunday)) == 1
    assert one(spark, event_hour(sunday)) == 14


def test_day_gap_is_first_minus_second(spark):
    assert one(spark, day_gap(F.lit(dt.date(2024, 1, 3)), F.lit(dt.date(2024, 1, 1)))) == 2


def test_id_prefix_keeps_short_ids_whole(spark):
    assert [one(spark, id_prefix(F.lit(i))) for i in (7, 1234, -56)] == ["7", "123", "-56"]


def test_exact_sum_does_not_depend_on_partitioning(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([(rng.choice([1e9, 0.1, 1e-7, 3.3]) * rng.random(),) for _ in range(500)], "x double")
    totals = {df.repartition(n).agg(exact_sum(F.col("x")).alias("s")).first().s for n in (1, 2, 3, 7)}
    assert len(totals) == 1


def test_exact_avg_ignores_null(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,)], "x double")
    assert df.agg(exact_avg(F.col("x")).alias("a")).first().a == 1.5
    assert df.filter("x > 5").agg(exact_avg(F.col("x")).alias("a")).first().a is None


def test_filters_on_edges(spark):
    bank(spark, 2)
    accounts = spark.sql(
        "select 1L as AccountID, 'S' as AccountType, 0.0D as Balance, 0.0D as ODLimit, 'USD' as Currency, "
        "date'2000-08-01' as DateOpened union all select 2L, 'S', -5.0D, 0.0D, 'USD', date'2000-07-31'"
    )
    used = acc.overdraft_usage(accounts).collect()
    assert [(r.AccountID, r.ODUtilizationPercent) for r in used] == [(2, None)]
    recent = acc.recent_low_balance_accounts(accounts, dt.date(2001, 8, 1))
    assert [r.AccountID for r in recent.collect()] == [1]
    payments = spark.sql("select 1L as PaymentID, 0.0D as Amount, 'USD' as Currency, 5.0D as Fee, 'x' as Description")
    assert acc.excessive_fee_payments(payments).isEmpty()


def test_fee_leakage_limits_are_parameters(spark):
    t = spark.sql("select 1L as TransactionID, '1' as AccountID, 100.0D as Amount, 0.5D as TransactionFee")
    assert acc.fee_leakage(t).first().Status == "Normal"
    strict = acc.fee_leakage(t, expected_share=0.02, leak_share=0.01).first()
    assert (strict.ExpectedFee, strict.Status) == (2.0, "Potential Leak")


def test_portfolio_share_with_a_third_currency(spark):
    accounts = spark.createDataFrame(
        [(1, 1, 10.5, "EUR"), (2, 1, 10.5, "JPY"), (3, 2, 10.0, "XXX")],
        "AccountID long, CustomerID long, Balance double, Currency string",
    )
    rates = risk.exchange_rates(spark).union(spark.createDataFrame([("JPY", 98.1)], "Currency string, r double"))
    row, = risk.portfolio_risk(accounts, rates).collect()
    assert (row.CustomerID, row.PortfolioValueUSD) == ("1", 2 * 11 * 98.0)
    assert row.VolatileCurrencySharePercent == pytest.approx(50.0)
    assert row.RiskLevel == "Low Risk"


@pytest.mark.parametrize("seed", [61, 62])
def test_prefix_reports_equal_the_joined_pairs(spark, seed):
    t = bank(spark, seed)
    expected = spark.sql("""
        select CustomerID, s as AccountBalances, f as TotalTransactionFees, o * 100 as ODUtilizationPercent,
          f + o * 100 * 0.02D - 1000 as Profitability
        from (select CustomerID, sum(Balance) as s, sum(TransactionFee) as f,
            avg(try_divide(ODLimit - Balance, ODLimit)) as o
          from accounts a join transactions t
            on substr(cast(a.AccountID as string), 1, 3) = substr(t.AccountID, 1, 3) group by CustomerID)""")
    report = prefix.customer_profitability(t["accounts"], t["transactions"])
    found, pairs = {r.CustomerID: r for r in report.collect()}, expected.collect()
    assert len(found) == len(pairs)
    for want in pairs:
        for column in expected.columns:
            have, wish = found[want.CustomerID][column], want[column]
            assert have == wish or have == pytest.approx(wish, rel=1e-6)
    sold = spark.sql("""
        select CustomerID, avg(Balance) as AvgAccountBalance, count_if(Amount > 10000) as HighValueTransactionsCount
        from accounts a join transactions t
          on substr(cast(a.AccountID as string), 1, 3) = substr(t.AccountID, 1, 3) group by CustomerID""")
    assert_same(prefix.cross_sell_opportunities(t["accounts"], t["transactions"]).drop("Eligibility"), sold)
    days = "datediff(to_date(TransactionDate, 'dd-MM-yyyy'), PaymentDate)"
    cleared = spark.sql(f"""
        select ClearingSystem, abs(avg({days})) as AvgProcessingTimeDays,
          cast(max({days}) as bigint) as MaxProcessingTimeDays, cast(min({days}) as bigint) as MinProcessingTimeDays
        from payments p join transactions t
          on substr(cast(p.PaymentID as string), 1, 3) = substr(cast(t.TransactionID as string), 1, 3)
        group by ClearingSystem""")
    assert_same(prefix.clearing_system_efficiency(t["payments"], t["transactions"]), cleared)


def test_prefix_reports_join_prefixes_of_text(spark):
    t = bank(spark, 63)
    named = F.concat(F.lit("AC"), F.col("AccountID").cast("string"))
    plain, text = ((
        f(t["accounts"].withColumn("AccountID", key), t["transactions"].withColumn("AccountID", key))
        for f in (prefix.customer_profitability, prefix.cross_sell_opportunities)
    ) for key in (F.col("AccountID").cast("string"), named))
    for of_numbers, of_text in zip(plain, text, strict=True):
        # Account ids have one digit here, so the prefixes pair the same rows with and without the letters.
        assert not of_text.isEmpty()
        assert_same(of_numbers, of_text)
