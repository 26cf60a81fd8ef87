"""Running totals and dense row numbers that never pass all rows through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from costledger.session import materialise

# Rows per block of a running total, and of a look at the previous row.
BLOCK = 65_536

# A table of scan segments is broadcast up to this many rows (about 100 bytes each).
MAX_BROADCAST_SEGMENTS = 200_000


def _block_of(key: str, block: int) -> Column:
    # never NULL: else a join filters one of its sides for it, and the two no longer share their shuffle
    return F.coalesce(F.floor(F.col(key) / block).cast("bigint"), F.lit(0))


def running_before(
    df: DataFrame, key: str, value: str, by: Sequence[str] = (), block: int = BLOCK, at_most: int | None = None
) -> DataFrame:
    """Add ``before``: the sum of ``value`` over the rows with a smaller ``key`` (unique, integral, in ``by``).

    Two levels: totals of blocks of keys are run up first, then each block on its own, so a window holds at most
    ``block`` rows, and the upper one a row per block. A table that is known to have ``at_most`` a block of rows
    needs one window only.
    """

    def sum_before(column: str, window: W) -> Column:
        return F.coalesce(F.sum(column).over(window.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))

    if at_most is not None and at_most <= block:
        return df.withColumn("before", sum_before(value, W.partitionBy(*by).orderBy(key)))
    blocked = df.withColumn("_block", _block_of(key, block))
    totals = blocked.groupBy(*by, "_block").agg(F.sum(value).alias("_total"))
    starts = totals.select(*by, "_block", sum_before("_total", W.partitionBy(*by).orderBy("_block")).alias("_start"))
    return (
        blocked.join(starts, [*by, "_block"])
        .withColumn("before", F.col("_start") + sum_before(value, W.partitionBy(*by, "_block").orderBy(key)))
        .drop("_block", "_start")
    )


def number_sorted(df: DataFrame, order: Sequence[Column | str], alias: str = "row_num", start: int = 0) -> DataFrame:
    """Number the rows in the given order, without gaps.

    A range sort spreads the rows over the tasks (give a unique order, then equal values spread too). The sorted
    rows are stored once together with their place, because the places must not change between the two
    reads; the counts per task then give each task its first number.
    """
    placed = df.orderBy(*order).withColumn("_pos", F.monotonically_increasing_id())
    stored = materialise(placed, "sorted").withColumn("_task", F.shiftright("_pos", 33))
    tasks = stored.groupBy("_task").agg(F.count("*").alias("_n"), F.min("_pos").alias("_first"))
    # a row per task of the sort, which these settings bound
    conf = df.sparkSession.conf
    settings = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    n_tasks = max(int(conf.get(name, None) or 0) for name in settings)
    before = running_before(tasks, "_task", "_n", at_most=n_tasks)
    offsets = before.select("_task", (F.col("before") - F.col("_first")).alias("_shift"))
    if n_tasks <= MAX_BROADCAST_SEGMENTS:
        offsets = F.broadcast(offsets)
    number = (F.col("_pos") + F.col("_shift") + start).cast("bigint")
    return stored.join(offsets, "_task").select(*df.columns, number.alias(alias))


def number_source(df: DataFrame, alias: str = "src_row", per_file: bool = False, start: int = 0) -> DataFrame:
    """Number the rows of a file scan in source order: by file path, then by place in the file.

    Parquet knows the place of a row in its file: only the row counts of the files are gathered, and nothing is
    stored. For text files see ``_number_splits``. ``df`` is a scan, whole, or carries ``source_file`` and
    ``source_split`` from one.
    """
    if "source_split" in df.columns:
        return _number_splits(df, alias, per_file, start)
    try:
        placed = df.select("*", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.row_index").alias("_pos"))
    except AnalysisException:  # not Parquet
        return _number_splits(with_source(df), alias, per_file, start)
    if per_file:
        offsets = None
        number = F.col("_pos") + start
    else:
        files = materialise(placed.groupBy("source_file").agg(F.count("*").alias("_n")), "files")
        offsets = rows_before(files, ["source_file"])
        number = F.col("_pos") + F.col("before") + start
    located = placed if offsets is None else placed.join(offsets, "source_file")
    return located.select(*df.columns, "source_file", number.cast("bigint").alias(alias))


def rows_before(pieces: DataFrame, keys: list[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows before each piece of a source, in order of ``keys`` (``_n`` rows each), broadcast where there are few pieces."""
    # numbers of the pieces in order of their keys are the key for the running total
    ranked = number_sorted(pieces, keys, "_rank")
    offsets = materialise(running_before(ranked, "_rank", "_n", by).drop("_rank", "_n"), "offsets")
    return F.broadcast(offsets) if offsets.count() <= MAX_BROADCAST_SEGMENTS else offsets


def _number_splits(df: DataFrame, alias: str, per_file: bool, start: int) -> DataFrame:
    """Number the rows of a text scan.

    Splits of a file may be packed into tasks in any order, so rows are placed by (file, split, place in the task).
    The scan is stored once: a second scan could be split in another way.
    """
    keys = ["source_file", "source_split"]
    stored = materialise(df.withColumn("_pos", F.monotonically_increasing_id()), "source")
    splits = stored.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_pos").alias("_first"))
    offsets = rows_before(splits, keys, ["source_file"] if per_file else [])
    number = (F.col("_pos") - F.col("_first") + F.col("before") + start).cast("bigint")
    kept = [c for c in df.columns if c != "source_split"]
    return stored.join(offsets, keys).select(*kept, number.alias(alias))


def with_source(scan: DataFrame) -> DataFrame:
    """Add file and split of each row to a file scan, from its hidden metadata."""
    return scan.select(
        "*",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("source_split"),
    )


def previous_value(
    df: DataFrame, by: str, order: str, value: str, alias: str = "previous", block: int = BLOCK
) -> DataFrame:
    """Add the ``value`` of the row before, in ``order`` (integral, unique) within ``by``.

    One file may hold all the rows, so a window over a file would be one task. Windows here cover blocks of the
    order column; the first row of a block takes the last value of the block before it that has rows.
    """
    # one shuffle serves the windows, the last values and the join
    blocked = df.withColumn("_block", _block_of(order, block)).repartition(by, "_block")
    last = blocked.groupBy(by, "_block").agg(F.max_by(value, order).alias("_last"))
    carried = last.select(
        by, "_block", F.lag("_last").over(W.partitionBy(by).orderBy("_block")).alias("_carried")
    )
    inside = W.partitionBy(by, "_block").orderBy(order)
    return (
        blocked.withColumn("_lag", F.lag(value).over(inside))
        .withColumn("_place", F.row_number().over(inside))
        .join(carried, [by, "_block"])
        .withColumn(alias, F.when(F.col("_place") == 1, F.col("_carried")).otherwise(F.col("_lag")))
        .drop("_block", "_lag", "_place", "_carried")
    )
