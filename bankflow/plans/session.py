"""Session settings that the plans are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE sizes the shuffle partitions, splits hot ones and turns joins with a small measured side into broadcasts.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(app: str, cores: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A session on this machine, for tests and timing. A cluster job gets SETTINGS from spark-submit instead."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = SETTINGS | {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": "8g",
    } | extra
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
