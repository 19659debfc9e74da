"""Country reports over the nested payload."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankflow.operators.ranking import top_in_group

# The limits of population below.
SMALL_POPULATION = 1_000_000
LARGE_POPULATION = 50_000_000


def union_payloads(payloads: list[DataFrame]) -> DataFrame:
    """Payloads one after another; a country in several of them stays several rows."""
    return reduce(DataFrame.unionByName, payloads)


def distinct_countries(countries: DataFrame) -> DataFrame:
    """One row per country: by its three-letter code, or by its common name where it has no code.

    Maps have no equality, so rows are compared by their JSON text. Of unlike rows of one country the least stays, however
    the rows are partitioned. Rows with neither code nor name are no copies of each other and are all kept.
    """
    key = F.coalesce(F.col("cca3"), F.col("name.common"))
    row = F.struct(*countries.columns)
    named = (
        countries.select(key.alias("_key"), row.alias("_row")).filter(F.col("_key").isNotNull())
        .groupBy("_key").agg(F.min_by("_row", F.to_json("_row", {"ignoreNullFields": "false"})).alias("_row"))
        .select("_row.*")
    )
    return named.unionByName(countries.filter(key.isNull()))


def risk_level() -> Column:
    """A NULL region or population takes no branch and ends as Medium, unless the other condition holds."""
    return (
        F.when((F.col("region") == "Africa") | (F.col("population") < SMALL_POPULATION), "High")
        .when((F.col("region") == "Europe") & (F.col("population") > LARGE_POPULATION), "Low")
        .otherwise("Medium")
    )


def country_risk_category(countries: DataFrame) -> DataFrame:
    """The raw columns with a risk level; the country name is at ``name.common``."""
    return countries.withColumn("risk_level", risk_level())


def currency_details(countries: DataFrame) -> DataFrame:
    """One row per country and currency; countries with no currency give none."""
    exploded = countries.select(
        F.col("name.common").alias("country"), "region",
        F.explode("currencies").alias("currency_code", "currency"),
    )
    return exploded.select(
        "country", "currency_code", F.col("currency.name").alias("currency_name"),
        F.col("currency.symbol").alias("currency_symbol"), "region",
    )


def largest_country_per_region(countries: DataFrame) -> DataFrame:
    rows = countries.select("region", F.col("name.common").alias("largest_country"), "population")
    return top_in_group(rows, "region", "population")
