"""File sources. Schemas are always declared: inference would read every file once more and may drift from day to day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankflow.plans.workspace import materialize

_CORRUPT = "_corrupt"


def read_csv_staging(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, header: bool = True, mode: str = "FAILFAST"
) -> DataFrame:
    return spark.read.schema(schema).option("header", header).option("mode", mode).csv(_paths(paths))


def read_json_lines(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, mode: str = "FAILFAST"
) -> DataFrame:
    """One JSON object per line; such files are splittable."""
    return spark.read.schema(schema).option("mode", mode).json(_paths(paths))


def read_nested_json(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, multi_line: bool = True,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Landed API payloads: each file holds a JSON array (or one object). All payloads are one scan with repeats kept.

    A payload that cannot be parsed fails the read instead of becoming a row of NULLs.
    """
    return (
        spark.read.schema(schema).option("mode", mode).option("multiLine", multi_line)
        .option("recursiveFileLookup", True).json(_paths(paths))
    )


def _at(schema: T.StructType, path: str) -> Column:
    """A field by its dotted path; a path that is not declared is an error of the contract, not of a payload."""
    at: T.DataType = schema
    for part in path.split("."):
        if not isinstance(at, T.StructType) or part not in at.fieldNames():
            raise ValueError(f"{path} is not a field of the schema")
        at = at[part].dataType
    return F.col(path)


def read_checked_json(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, required: Sequence[str],
    multi_line: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Landed API payloads, held against a contract: rows that keep it, and those refused.

    A row is refused if it is no JSON of the declared types (a text where a number is declared, a cut file), or if one of
    the ``required`` fields (dotted paths) is missing, as in the body of an error response. Refused rows have the file,
    the reason and what was read of them as JSON, for a quarantine table. Every file is parsed once.
    """
    missing = [F.when(_at(schema, path).isNull(), F.lit(f"missing {path}")) for path in required]
    reason = F.coalesce(F.when(F.col(_CORRUPT).isNotNull(), F.lit("unreadable")), *missing)
    parsed = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())]))
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT).option("multiLine", multi_line)
        .option("recursiveFileLookup", True).json(_paths(paths))
    )
    judged = materialize(
        parsed.select("*", F.col("_metadata.file_path").alias("_file")).withColumn("_reason", reason), "payloads")
    payload = F.coalesce(F.col(_CORRUPT), F.to_json(F.struct(*schema.fieldNames())))
    accepted = judged.filter("_reason is null").select(*schema.fieldNames())
    refused = judged.filter("_reason is not null").select(
        F.col("_file").alias("file"), F.col("_reason").alias("reason"), payload.alias("payload"))
    return accepted, refused


def load_payloads(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, required: Sequence[str], quarantine: str,
    multi_line: bool = True,
) -> DataFrame:
    """The accepted rows; refused ones are added to the Parquet table ``quarantine``."""
    accepted, refused = read_checked_json(spark, paths, schema, required, multi_line)
    refused.write.mode("append").parquet(quarantine)
    return accepted


def _paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)
