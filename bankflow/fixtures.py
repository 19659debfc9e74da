"""Bank tables over the test tables, for the queries and their checks.

Whole tables are mapped, without any subset: accounts from customer, transactions from orders, payments from lineitem,
countries from customer with its nation and region, branches from supplier, loans from orders. A tenth of the payments
come from an account in the table and fewer go to one; the other ends belong to other banks.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankflow.schemas import BRANCH, BRANCH_STAGING, COUNTRIES, CUSTOMER, CUSTOMER_STAGING, LOANS_STAGING, conform

AS_OF = dt.date(2001, 8, 1)
DAY_1 = dt.datetime(2001, 7, 31, 6, 0)
DAY_2 = dt.datetime(2001, 8, 1, 6, 0)

# Currencies of the country fixture (code, name, symbol).
CURRENCIES = [
    ("USD", "United States dollar", "$"),
    ("EUR", "Euro", "€"),
    ("SGD", "Singapore dollar", "S$"),
    ("INR", "Indian rupee", "₹"),
    ("CAD", "Canadian dollar", "C$"),
]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS AccountID",
        "c_custkey DIV 3 AS CustomerID",
        "CASE c_custkey % 3 WHEN 0 THEN 'Savings' WHEN 1 THEN 'Current' ELSE 'Business' END AS AccountType",
        "c_acctbal * 10 AS Balance",
        "CAST((c_custkey % 11) * 200 AS double) AS ODLimit",
        "CAST(300 + (c_custkey * 37) % 550 AS bigint) AS CreditScore",
        "CASE c_custkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' ELSE 'INR' END AS Currency",
        "date_sub(DATE '2001-08-01', CAST(c_custkey % 1500 AS int)) AS DateOpened",
        "CAST(c_nationkey AS bigint) AS ManagerID",
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").withColumn(
        "day", F.date_format(F.col("o_orderdate").cast("date"), "dd-MM-yyyy")
    ).selectExpr(
        "o_orderkey AS TransactionID",
        "CAST(o_custkey AS string) AS AccountID",
        "o_totalprice / 10 AS Amount",
        "CASE o_orderkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' ELSE 'INR' END AS Currency",
        "CASE o_orderstatus WHEN 'F' THEN 'Failed' WHEN 'O' THEN 'Pending' ELSE 'Success' END AS Status",
        "CASE WHEN o_orderkey % 2 = 0 THEN 'Debit' ELSE 'Credit' END AS TransactionType",
        "day || ' ' || lpad(CAST(o_orderkey % 24 AS string), 2, '0') || ':'"
        " || lpad(CAST(o_orderkey % 60 AS string), 2, '0') AS EventTs",
        "day AS TransactionDate",
        "o_totalprice / 10 * (o_orderkey % 5) * 0.0005D AS TransactionFee",
        "(o_orderpriority = '1-URGENT' AND o_orderkey % 5 = 0) AS Suspecious",
        "o_orderpriority AS Description",
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS PaymentID",
        "CAST(l_orderkey AS string) AS FromAccountID",
        "CAST(l_partkey * 100 + l_suppkey % 100 AS string) AS ToAccountID",
        "l_extendedprice AS Amount",
        "CASE l_suppkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' ELSE 'INR' END AS Currency",
        "CASE l_suppkey % 4 WHEN 0 THEN 1.0D WHEN 1 THEN 1.1D WHEN 2 THEN 1.3D ELSE 0.012D END AS ExchangeRate",
        "CAST(l_shipdate AS date) AS PaymentDate",
        "'Merchant#' || CAST(l_suppkey AS string) AS MerchantName",
        "l_returnflag || l_linestatus AS Description",
        "CASE l_suppkey % 3 WHEN 0 THEN 'SWIFT' WHEN 1 THEN 'SEPA' ELSE 'ACH' END AS ClearingSystem",
        "CASE WHEN l_linestatus = 'O' THEN 'Retail' ELSE 'Corporate' END AS CustomerSegment",
        "CASE l_linenumber % 2 WHEN 0 THEN 'Wire' ELSE 'Card' END AS PaymentType",
        "l_extendedprice * l_tax AS Fee",
    )


def customer_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS CustomerID",
        "'First' || c_custkey AS FirstName",
        "c_mktsegment AS LastName",
        "date_add(DATE '1950-01-01', CAST(c_custkey % 18000 AS int)) AS DateOfBirth",
        "'user' || c_custkey || '@example.com' AS Email",
        "'555-' || lpad(CAST(c_custkey AS string), 7, '0') AS PhoneNumber",
        "c_custkey || ' Old Street' AS Address",
        "CAST(c_nationkey AS bigint) AS BranchID",
        "TIMESTAMP '2001-01-01 00:00:00' AS last_update",
    )
    return conform(rows, CUSTOMER)


def customer_staging(spark: SparkSession, sf_dir: str, step: int = 2) -> DataFrame:
    """Customers numbered in steps, so that some exist in the target and the others are new."""
    rows = read(spark, sf_dir, "customer").withColumn("id", F.col("c_custkey") * step).selectExpr(
        "id AS CustomerID",
        "'First' || id AS FirstName",
        "c_mktsegment AS LastName",
        "CAST(date_add(DATE '1950-01-01', CAST(id % 18000 AS int)) AS string) AS DateOfBirth",
        "CASE WHEN id % 7 = 0 THEN NULL ELSE 'user' || id || '@example.com' END AS Email",
        "'555-' || lpad(CAST(id AS string), 7, '0') AS PhoneNumber",
        f"id || ' New Street {step}' AS Address",
        "CAST(c_nationkey AS bigint) AS BranchID",
    )
    return conform(rows, CUSTOMER_STAGING)


def branch_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS BranchID",
        "'Branch' AS FirstName",
        "s_name AS LastName",
        "date_add(DATE '1950-01-01', CAST(s_suppkey % 18000 AS int)) AS DateOfBirth",
        "'branch' || s_suppkey || '@example.com' AS Email",
        "'555-' || lpad(CAST(s_suppkey AS string), 7, '0') AS PhoneNumber",
        "s_suppkey || ' Old Square' AS Address",
        "TIMESTAMP '2001-01-01 00:00:00' AS last_update",
    )
    return conform(rows, BRANCH)


def branch_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "supplier").withColumn("id", F.col("s_suppkey") * 2).selectExpr(
        "id AS BranchID",
        "'Branch' AS FirstName",
        "s_name AS LastName",
        "CAST(date_add(DATE '1950-01-01', CAST(id % 18000 AS int)) AS string) AS DateOfBirth",
        "'branch' || id || '@example.com' AS Email",
        "'555-' || lpad(CAST(id AS string), 7, '0') AS PhoneNumber",
        "id || ' New Square' AS Address",
    )
    return conform(rows, BRANCH_STAGING)


def loans_staging(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    """Day 1 numbers the loans as the orders, day 2 by even numbers: half of them known, half new.

    A loan's values follow from its number, so a known loan comes back unchanged unless day 2 alters the rate, or the
    collateral from or to NULL.
    """
    changed = "id % 6 = 0" if day == 2 else "false"
    no_collateral = "id % 10 = 4" if day == 2 else "id % 14 = 0"
    rows = read(spark, sf_dir, "orders").withColumn("id", F.col("o_orderkey") * day).selectExpr(
        "date_add(DATE '1995-01-01', CAST(id % 2400 AS int)) AS StartDate",
        "CASE id % 3 WHEN 0 THEN 'Home' WHEN 1 THEN 'Auto' ELSE 'Personal' END AS LoanType",
        "CASE id % 4 WHEN 0 THEN 'Monthly' ELSE 'Weekly' END AS PaymentFrequency",
        f"1 + id % 70 / 10D + CASE WHEN {changed} THEN 0.5D ELSE 0D END AS InterestRate",
        "o_custkey AS CustomerID",
        "CASE id % 5 WHEN 0 THEN 'Closed' ELSE 'Active' END AS Status",
        "id AS LoanID",
        "CAST(1000 + (id * 7919) % 900000 AS double) AS Amount",
        "date_add(DATE '1995-01-01', CAST(id % 2400 AS int) + 3650) AS EndDate",
        f"CASE WHEN {no_collateral} THEN NULL ELSE 'Property' END AS Collateral",
    )
    return conform(rows, LOANS_STAGING)


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested country rows. A country has none to three of the currencies; populations repeat, so there are ties."""
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    entries = ", ".join(f"named_struct('k', '{c}', 'v', named_struct('name', '{n}', 'symbol', '{s}'))"
                        for c, n, s in CURRENCIES * 2)
    flat = (
        read(spark, sf_dir, "customer")
        .join(nation, F.expr("c_nationkey = n_nationkey")).join(region, F.expr("n_regionkey = r_regionkey"))
        .withColumn("common", F.expr("replace(c_name, 'Customer', 'Country')"))
        .withColumn("picked", F.expr(f"slice(array({entries}), CAST(c_custkey % 5 AS int) + 1,"
                                     " CAST(c_custkey % 4 AS int))"))
    )
    known = {
        "name": "named_struct('common', common, 'official', common || ' Republic', 'nativeName',"
                " map('eng', named_struct('official', common || ' Republic', 'common', common)))",
        "currencies": "map_from_entries(picked)",
        "region": "initcap(lower(r_name))",
        "subregion": "n_name",
        "population": "((c_custkey * 7919) % 97) * 1000000 + (c_custkey % 3) * 300000",
        "independent": "true",
        "tld": "array('.x' || c_nationkey)",
        "latlng": "array(CAST(c_custkey % 90 AS double), CAST(c_custkey % 180 AS double))",
        "area": "CAST(c_custkey * 11 AS double)",
        "languages": "map('eng', 'English')",
        "car": "named_struct('signs', array('C'), 'side', 'right')",
    }
    return flat.select(*[
        (F.expr(known[f.name]) if f.name in known else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in COUNTRIES.fields
    ])
