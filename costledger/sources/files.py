"""Choice and fingerprints of input files."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costledger.sources.blocks import can_open, listed, open_file, over_rows, steps

# File types in order of preference.
PREFERRED_SUFFIXES = (".xlsx", ".xlsm", ".csv")


def _listing(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    # the file contents are not selected, so they are not read
    return (
        spark.read.format("binaryFile")
        .load(folder)
        .select("path", F.element_at(F.split("path", "/"), -1).alias("name"))
        .where(F.col("name").contains(pattern))
    )


def table_names(spark: SparkSession, package: str) -> list[str]:
    """Names of the CSV files, or folders of such files, right below a folder; none if it does not exist."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
    try:
        paths = listing.load(package).select("path")
    except AnalysisException:
        return []
    base = package.rstrip("/").rsplit("/", 1)[-1]
    below = F.regexp_extract("path", f"/{re.escape(base)}/([^/]+)", 1)
    return sorted(r["name"] for r in paths.select(below.alias("name")).distinct().where("name <> ''").collect())


def candidate_files(
    spark: SparkSession, folder: str, pattern: str, suffixes: Sequence[str] = PREFERRED_SUFFIXES
) -> DataFrame:
    """Files whose name contains ``pattern``, ranked by type; lock files of open workbooks are skipped."""
    suffix = F.lower(F.regexp_extract("name", r"\.[^.]*$", 0))
    rank = F.array_position(F.lit(list(suffixes)), suffix)
    return (
        _listing(spark, folder, pattern)
        .where(~F.col("name").startswith("~$") & (rank > 0))
        .select("path", "name", rank.cast("int").alias("type_rank"))
    )


def choose_file(
    spark: SparkSession, folder: str, pattern: str, suffixes: Sequence[str] = PREFERRED_SUFFIXES
) -> DataFrame:
    """The one file to read: best type first, then the name in any case."""
    return candidate_files(spark, folder, pattern, suffixes).orderBy("type_rank", F.lower("name"), "name").limit(1)


def find_file(
    spark: SparkSession, folder: str, pattern: str, suffixes: Sequence[str] = PREFERRED_SUFFIXES
) -> str:
    """Path of the chosen file; an error names what was looked for."""
    row = choose_file(spark, folder, pattern, suffixes).first()
    if row is None:
        raise FileNotFoundError(f"No file of type {', '.join(suffixes)} with '{pattern}' in its name in {folder}")
    return row["path"]


def _digest(row: dict) -> Iterator[pa.RecordBatch]:
    digest = hashlib.sha256()
    with open_file(row["path"]) as file:
        for data in steps(file, 0, row["length"]):
            digest.update(data)
    yield pa.RecordBatch.from_pylist([{**row, "sha256": digest.hexdigest()}])


def fingerprints(spark: SparkSession, path: str | list[str], pattern: str = "*") -> DataFrame:
    """``path``, ``name``, ``length`` and SHA-256 of each file, files in parallel.

    A task streams its file block by block, so files of any size fit; Spark does not list empty files. Where tasks cannot open the files by themselves (a scheme
    that only Spark reads), whole contents are hashed by Spark, which rejects a single file above 2 GB.
    """
    files = listed(spark, path, pattern)
    first = files.select("path").first()
    if first is None or can_open(first["path"]):
        hashed = over_rows(files, _digest, "path string, length long, sha256 string")
    else:
        contents = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
        hashed = contents.select("path", "length", F.sha2("content", 256).alias("sha256"))
    return hashed.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length", "sha256")


def fingerprint() -> Column:
    """One digest for an input, aggregated over ``fingerprints``: that of its file, or that of the sorted digests of its files, whatever their names."""
    digests = F.array_join(F.array_sort(F.collect_list("sha256")), "\n")
    return F.when(F.count("*") == 1, F.max("sha256")).otherwise(F.sha2(digests, 256)).alias("sha256")


def input_fingerprint(spark: SparkSession, path: str | list[str], pattern: str = "*") -> str:
    return fingerprints(spark, path, pattern).agg(fingerprint()).first()["sha256"]
