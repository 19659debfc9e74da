"""The registered query of each operator, over its whole table, and the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bankflow.llm.bpe import token_digest
from bankflow.llm.fingerprints import fingerprint_digest
from bankflow.llm.hard_negatives import hard_negatives_digest
from bankflow.llm.line_dedup import line_dedup_digest
from bankflow.llm.manifest import manifest_digest
from bankflow.llm.mixing import mix_digest
from bankflow.llm.near_dup import near_dup_digest
from bankflow.llm.oracles import ORACLES as ORACLES
from bankflow.llm.pii import pii_digest
from bankflow.llm.quality_model import quality_model_digest
from bankflow.llm.quality_rules import quality_digest
from bankflow.llm.sharding import shard_digest
from bankflow.llm.toxicity import toxicity_digest
from bankflow.llm.warc import warc_digest


def _over(table: str, digest: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: digest(spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def _documents(digest: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return _over("documents", digest)


def _labelled(digest: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: digest(
        spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": _documents(pii_digest),
    "op2_byte_bpe": _documents(token_digest),
    "op3_sharding": _documents(shard_digest),
    "op4_mixing": _documents(mix_digest),
    "op5_fingerprints": _documents(fingerprint_digest),
    "op6_line_dedup": _documents(line_dedup_digest),
    "op7_near_duplicates": _documents(near_dup_digest),
    "op8_toxicity": _labelled(toxicity_digest),
    "op9_quality_rules": _documents(quality_digest),
    "op10_quality_model": _labelled(quality_model_digest),
    "op11_warc": _over("pages", warc_digest),
    "op12_manifest": _documents(manifest_digest),
    "op13_hard_negatives": _over("embeddings", hard_negatives_digest),
}
