"""Where intermediate and output tables are written.

The cluster names a shared folder in ``spark.checkpoint.dir``. Only a local session without that setting gets a temporary
folder of its own; on a cluster a machine-local folder would not survive a lost executor.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="bankflow-")
    return _local_dirs[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    """A path that no earlier run has used, so a rerun never overwrites what it reads.

    All paths of an application lie under one folder, which can be dropped when the application has ended.
    """
    return f"{shared_dir(spark)}/bankflow-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write once, read back.

    Cuts the lineage, and gives Catalyst the true size of the table: a small one is broadcast by the optimizer's own
    size check, a large one is shuffled.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """The same, with the number of rows, counted while they are written."""
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    written = materialize(df.observe(seen, F.count(F.lit(1)).alias("rows")), name)
    return written, seen.get["rows"]
