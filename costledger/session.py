"""Session settings and the shared folder for materialised intermediate tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # splits a hot key of a shuffled join over several tasks
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

_local_folders: dict[str, str] = {}


def build_session(app: str = "costledger", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the jobs are tuned for; keyword settings use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("_", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions(input_bytes: int, target_bytes: int = 128 * 1024**2, least: int = 200) -> int:
    """A value for ``spark.sql.shuffle.partitions`` at which a partition of the whole input fits a task.

    Set it for jobs that shuffle rows; adaptive execution merges the partitions of smaller shuffles again.
    """
    return max(least, -(-input_bytes // target_bytes))


def fit_shuffles(*inputs: DataFrame) -> None:
    """Set the session's number of shuffle partitions for jobs over these inputs, by their estimated size; it never falls."""
    spark = inputs[0].sparkSession
    estimate = sum(int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for df in inputs)
    now = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # an unknown size is reported as the largest number there is
    wanted = now if estimate >= 2**62 else shuffle_partitions(estimate, least=now)
    spark.conf.set("spark.sql.shuffle.partitions", str(wanted))


def shared_folder(spark: SparkSession) -> str:
    """The cluster's folder for intermediate data, as ``spark.checkpoint.dir`` names it.

    Unset, a temporary folder is taken in local mode only: on a cluster the executors could not see it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="costledger-")
    return _local_folders[application]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return os.path.join(shared_folder(spark), "costledger", uuid.uuid4().hex, name)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage like a checkpoint, survives the loss of executors, and stays columnar, so later
    readers still prune columns.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
