"""Portfolio risk over foreign-currency balances."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankflow.functions import exact_sum, percent, to_int64
from bankflow.operators.joins import accounts_with_rates
from bankflow.schemas import EXCHANGE_RATES, PORTFOLIO_RISK, conform

# The seeded rates, the currencies counted as volatile and the risk limits.
SEED_RATES = [("EUR", 98.1), ("GBP", 66.3)]
VOLATILE_CURRENCIES = ("GBP", "EUR")
HIGH_RISK_VALUE = 500_000
HIGH_RISK_SHARE = 50
MEDIUM_RISK_VALUE = 200_000


def exchange_rates(spark: SparkSession) -> DataFrame:
    """The seeded rates as literal rows of a query, whose size the optimizer knows."""
    rows = ", ".join(f"('{currency}', {rate}D)" for currency, rate in SEED_RATES)
    return conform(spark.sql(f"SELECT * FROM VALUES {rows} AS rates({', '.join(EXCHANGE_RATES.fieldNames())})"), EXCHANGE_RATES)


def portfolio_risk(accounts: DataFrame, rates: DataFrame) -> DataFrame:
    """Value, volatile share and risk level per customer.

    The value multiplies balance and rate after each is rounded to an integer; the share uses them unrounded.
    """
    value = F.col("Balance") * F.col("ExchangeRate")
    volatile = F.when(F.col("Currency").isin(*VOLATILE_CURRENCIES), value).otherwise(0.0)
    portfolio = accounts_with_rates(accounts, rates).groupBy("CustomerID").agg(
        F.sum(to_int64(F.col("Balance")) * to_int64(F.col("ExchangeRate"))).alias("PortfolioValueUSD"),
        percent(exact_sum(volatile), exact_sum(value)).alias("VolatileCurrencySharePercent"),
    )
    level = (
        F.when(
            (F.col("PortfolioValueUSD") > HIGH_RISK_VALUE) & (F.col("VolatileCurrencySharePercent") > HIGH_RISK_SHARE),
            "High Risk",
        )
        .when(F.col("PortfolioValueUSD") > MEDIUM_RISK_VALUE, "Medium Risk")
        .otherwise("Low Risk")
    )
    return conform(portfolio.withColumn("RiskLevel", level), PORTFOLIO_RISK)
