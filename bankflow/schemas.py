"""Declared tables. ``conform`` is the assignment cast that an INSERT into a declared table applies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STRING, _LONG, _DOUBLE, _BOOLEAN = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()
_TYPES = {
    "string": _STRING, "bigint": _LONG, "double": _DOUBLE, "boolean": _BOOLEAN, "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _table(columns: str) -> T.StructType:
    """``name type, name type`` as a schema. Unlike ``fromDDL`` this needs no session at import."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _by_code(kind: T.DataType) -> T.MapType:
    return T.MapType(_STRING, kind)


# Names and types of the tables that callers read and write.
CUSTOMER = _table(
    "CustomerID bigint, FirstName string, LastName string, DateOfBirth date, Email string, PhoneNumber string, "
    "Address string, BranchID bigint, last_update timestamp"
)
BRANCH = _table(
    "BranchID bigint, FirstName string, LastName string, DateOfBirth date, Email string, PhoneNumber string, "
    "Address string, last_update timestamp"
)
LOANS = _table(
    "StartDate date, LoanType string, PaymentFrequency string, InterestRate double, CustomerID bigint, Status string, "
    "LoanID bigint, Amount double, EndDate date, Collateral string, is_current boolean, valid_from timestamp, "
    "valid_to timestamp"
)
EXCHANGE_RATES = _table("Currency string, ExchangeRate double")
POTENTIAL_FRAUD_ACCOUNTS = _table(
    "AccountID string, TransactionID bigint, PaymentID string, Suspicious boolean, CreditScore bigint, "
    "TotalFlaggedEvents bigint"
)
RECONCILIATION_REPORT = _table(
    "PaymentID string, ClearingSystem1 string, ClearingSystem2 string, AmountDifferencePercent double, "
    "DateDifferenceDays bigint, Status string"
)
ACTIVITY_HEATMAP = _table(
    "AccountID string, DayOfWeek bigint, HourOfDay bigint, TransactionCount bigint, AvgTransactionAmount double"
)
PORTFOLIO_RISK = _table(
    "CustomerID string, PortfolioValueUSD double, VolatileCurrencySharePercent double, RiskLevel string"
)
FEE_LEAKAGE = _table(
    "TransactionID bigint, AccountID string, Amount double, TransactionFee double, ExpectedFee double, Status string"
)
CUSTOMER_PROFITABILITY = _table(
    "CustomerID bigint, AccountBalances double, TotalTransactionFees double, ODUtilizationPercent double, "
    "Profitability double"
)
CROSS_SELL_OPPORTUNITIES = _table(
    "CustomerID bigint, AvgAccountBalance double, HighValueTransactionsCount bigint, Eligibility string"
)
CLEARING_SYSTEM_EFFICIENCY = _table(
    "ClearingSystem string, AvgProcessingTimeDays double, MaxProcessingTimeDays bigint, MinProcessingTimeDays bigint"
)

# Staging files carry the birth date as text and no audit columns.
CUSTOMER_STAGING = _table(
    "CustomerID bigint, FirstName string, LastName string, DateOfBirth string, Email string, PhoneNumber string, "
    "Address string, BranchID bigint"
)
BRANCH_STAGING = _table(
    "BranchID bigint, FirstName string, LastName string, DateOfBirth string, Email string, PhoneNumber string, "
    "Address string"
)
LOANS_STAGING = _table(
    "StartDate date, LoanType string, PaymentFrequency string, InterestRate double, CustomerID bigint, Status string, "
    "LoanID bigint, Amount double, EndDate date, Collateral string"
)
# The same with the time of arrival, for runs that take several days at once.
LOANS_STAGING_TIMED = T.StructType([*LOANS_STAGING.fields, T.StructField("arrived", T.TimestampType())])

# The nested country payload. Numbers are double and bigint, so whole numbers and large areas both parse.
_TEXTS = T.ArrayType(_STRING)
_NUMBERS = T.ArrayType(_DOUBLE)
_TITLES = _struct(official=_STRING, common=_STRING)
COUNTRIES = _struct(
    name=_struct(common=_STRING, official=_STRING, nativeName=_by_code(_TITLES)),
    tld=_TEXTS, cca2=_STRING, ccn3=_STRING, cca3=_STRING, cioc=_STRING,
    independent=_BOOLEAN, status=_STRING, unMember=_BOOLEAN,
    currencies=_by_code(_struct(name=_STRING, symbol=_STRING)),
    idd=_struct(root=_STRING, suffixes=_TEXTS),
    capital=_TEXTS, altSpellings=_TEXTS, region=_STRING, subregion=_STRING,
    languages=_by_code(_STRING), translations=_by_code(_TITLES),
    latlng=_NUMBERS, landlocked=_BOOLEAN, borders=_TEXTS, area=_DOUBLE,
    demonyms=_by_code(_struct(f=_STRING, m=_STRING)),
    flag=_STRING, maps=_struct(googleMaps=_STRING, openStreetMaps=_STRING),
    population=_LONG, gini=_by_code(_DOUBLE), fifa=_STRING,
    car=_struct(signs=_TEXTS, side=_STRING),
    timezones=_TEXTS, continents=_TEXTS,
    flags=_struct(png=_STRING, svg=_STRING, alt=_STRING),
    coatOfArms=_struct(png=_STRING, svg=_STRING),
    startOfWeek=_STRING, capitalInfo=_struct(latlng=_NUMBERS),
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, in its order, cast to its types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
