"""Table sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from bankflow.schemas import conform


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def overwrite_table(
    df: DataFrame, path: str, schema: T.StructType | None = None, partition_by: Sequence[str] = ()
) -> None:
    """Replace a table; with ``schema`` the rows are first cast to the declared columns."""
    df = df if schema is None else conform(df, schema)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def save_table(df: DataFrame, name: str, mode: str = "overwrite", path: str | None = None) -> None:
    """Create, replace or extend a catalog table; ``mode`` is overwrite, append, ignore or error."""
    writer = df.write.mode(mode).format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def create_if_absent(spark: SparkSession, name: str, schema: T.StructType, path: str | None = None) -> None:
    """CREATE TABLE IF NOT EXISTS with declared columns."""
    save_table(spark.createDataFrame([], schema), name, mode="ignore", path=path)
