"""An index over stored statements, so that one statement is read out of the files that hold it and no others.

Statements are written sorted by staff id. The index has a row for each staff id and file, with the place of the rows in the file, and is
sorted by staff id itself: a lookup reads a few of its row groups, then the named files, of which Parquet skips the row groups of others.
An index belongs to a set of files: over tables that were written anew since, it is not used, and the whole table is filtered instead.
"""

from __future__ import annotations

import hashlib
import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costledger.sinks import versions


def _index_path(path: str) -> str:
    return f"{path.rstrip('/')}_index"


def _files(stored: DataFrame) -> str:
    """Digest of the names of a table's files, which are new with each write."""
    names = sorted(posixpath.basename(file) for file in stored.inputFiles())
    return hashlib.sha256("\n".join(names).encode()).hexdigest()


def index_statements(spark: SparkSession, path: str) -> None:
    """Index the statements that are stored in one folder. Reads the staff ids only; ids and files are counted before the shuffle."""
    stored = spark.read.parquet(path)
    place = F.col("_metadata.row_index")
    index = (
        stored.where("staff_id IS NOT NULL")
        .groupBy("staff_id", F.col("_metadata.file_name").alias("file"))
        .agg(F.min(place).alias("first_row"), F.max(place).alias("last_row"), F.count("*").alias("n_rows"))
    )
    versions.replace(index.orderBy("staff_id", "file"), _index_path(path), _files(stored))


def statement_index(spark: SparkSession, path: str) -> DataFrame | None:
    """The index of the files that are there now, or None."""
    commits = versions.commits(spark, _index_path(path))
    if commits.where(F.col("key") == _files(spark.read.parquet(path))).isEmpty():
        return None
    return versions.read_table(spark, _index_path(path))


def read_statement(spark: SparkSession, path: str, staff_id: str) -> DataFrame:
    """The rows of one statement with its TOTAL row; none for an unknown id."""
    stored, one = spark.read.parquet(path), F.col("staff_id") == staff_id
    index = statement_index(spark, path)
    if index is None:
        return stored.where(one)
    # the files of one member of staff: one, or a few for very many rows
    files = [r["file"] for r in index.where(one).select("file").collect()]
    if not files:
        return spark.createDataFrame([], stored.schema)
    return spark.read.schema(stored.schema).parquet(*[f"{path.rstrip('/')}/{file}" for file in files]).where(one)
