"""Tables that are replaced or appended to as a whole: a reader sees what was committed, and nothing of a write that died.

A table is a folder with ``data``, a folder for each version, and ``log``, a folder for each commit. A version is written in full, under a
new name, before its commit; a commit is one row in one file, which Spark's committer renames into place, so it is there or not. Files of a
write that died are named by no commit. ``replace`` makes its version the only one; ``append`` adds one under a key, and a key that is there
since the last replacement is not added again, so a repeated job adds nothing. Versions that are out of use stay for readers that
have begun; ``unused`` names them.

One writer at a time is assumed. Of two replacements with the same number the greater name counts; appends both do.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMIT = "number long, kind string, key string, version string"
REPLACE, APPEND = "replace", "append"


#: Folders are named as Spark names those of partitions, so a table may have folders of its own below.
VERSION = "table_version"


def _folder(path: str, version: str) -> str:
    return f"{path}/data/{VERSION}={version}"


def commits(spark: SparkSession, path: str) -> DataFrame:
    """The commits of a table since its last replacement; none if there is no table."""
    try:
        log = spark.read.schema(COMMIT).json(f"{path}/log/*")
    except AnalysisException:
        return spark.createDataFrame([], COMMIT)
    place = F.struct("number", "version")
    last = log.where(F.col("kind") == REPLACE).agg(F.max(place).alias("last"))
    return log.join(F.broadcast(last), F.col("last").isNull() | (place >= F.col("last"))).drop("last")


def _write(df: DataFrame, path: str, kind: str, key: str, number: int, folders: Sequence[str] = ()) -> None:
    spark, version = df.sparkSession, uuid.uuid4().hex
    df.write.partitionBy(*folders).parquet(_folder(path, version))
    row = spark.createDataFrame([(number, kind, key, version)], COMMIT).coalesce(1)
    row.write.json(f"{path}/log/{number:012d}-{version}")


def _next_number(spark: SparkSession, path: str) -> int:
    return (commits(spark, path).agg(F.max("number")).first()[0] or 0) + 1


def replace(df: DataFrame, path: str, key: str = "") -> None:
    """Make ``df`` the content of the table. ``df`` may be read from the table itself."""
    _write(df, path, REPLACE, key, _next_number(df.sparkSession, path))


def append(df: DataFrame, path: str, key: str, folders: Sequence[str] = ()) -> bool:
    """Add the rows of ``df`` under ``key``, unless that is done; whether it was done now. ``folders``: columns whose values are folders."""
    known = commits(df.sparkSession, path)
    if not known.where(F.col("key") == key).isEmpty():
        return False
    _write(df, path, APPEND, key, _next_number(df.sparkSession, path), folders)
    return True


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The content of the table. Without a commit it has no rows if a ``schema`` is given, and else is an error."""
    versions = [_folder(path, r["version"]) for r in commits(spark, path).select("version").orderBy("version").collect()]  # a row a load
    if versions:
        reader = spark.read.option("basePath", f"{path}/data")
        return (reader.schema(schema) if schema else reader).parquet(*versions).drop(VERSION)
    if schema is None:
        raise FileNotFoundError(f"No committed table in {path}")
    return spark.createDataFrame([], schema)


def unused(spark: SparkSession, path: str) -> DataFrame:
    """``path`` of each data file that the table does not use any more, or never did."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{path}/data").select("path")
    version = F.regexp_extract("path", f"/data/{VERSION}=([0-9a-f]{{32}})/", 1)
    return files.join(F.broadcast(commits(spark, path).select("version")), version == F.col("version"), "left_anti")
