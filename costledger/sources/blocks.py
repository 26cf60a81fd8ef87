"""Byte ranges of files, read inside tasks: for what Spark's own scans cannot do, such as files beyond 2 GB in one piece or a state at the start of a split.

A table of blocks (path, offset, size) comes out of Spark's file listing; its rows are dealt to the tasks, and each task opens its files itself
and reads them step by step. No content and no list of blocks passes the driver.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a block, and of one read.
BLOCK_BYTES = 64 * 1024**2
STEP = 1024**2

#: Schemes whose files a task can open by itself.
OPENED = ("file", "hdfs", "s3", "s3a", "gs")

#: Most tasks of one pass; a task takes several blocks beyond.
MOST_TASKS = 50_000


def listed(spark: SparkSession, path: str | list[str], pattern: str = "*") -> DataFrame:
    """``path`` and ``length`` of all files; their content is not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "length")


def can_open(path: str) -> bool:
    scheme = re.match(r"([a-zA-Z][a-zA-Z0-9+.-]*):", path)
    return scheme is None or scheme[1].lower() in OPENED


def open_file(path: str) -> pa.NativeFile:
    """A file that can be read from any place, by the path that Spark lists."""
    local = re.match(r"(?:file:/*)?(/.*)", path if not path.startswith("file:") else "file:" + "/" + path[5:].lstrip("/"))
    if local:
        return fs.LocalFileSystem().open_input_file(local[1])
    scheme, rest = path.split(":", 1)
    system, inner = fs.FileSystem.from_uri(f"{'s3' if scheme.lower() == 's3a' else scheme}:{quote(rest)}")
    return system.open_input_file(inner)


def steps(file: pa.NativeFile, offset: int, end: int) -> Iterator[bytes]:
    """The bytes of a range, one step after the other."""
    file.seek(offset)
    while offset < end:
        data = file.read(min(STEP, end - offset))
        if not data:
            return
        yield data
        offset += len(data)


def blocks_of(files: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``path``, ``length`` (of the file), ``offset`` and ``size`` of each block; an empty file has none."""
    offsets = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(block_bytes).cast("long")))
    placed = files.where("length > 0").select("path", "length", offsets.alias("offset"))
    return placed.withColumn("size", F.least(F.lit(block_bytes), F.col("length") - F.col("offset")).cast("long"))


def over_rows(rows: DataFrame, function: Callable[[dict], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """``function`` for each row (a file or a block), a task a row as far as there are enough tasks."""
    tasks = max(1, min(MOST_TASKS, rows.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from function(row)

    return rows.repartition(tasks).mapInArrow(run, schema)
