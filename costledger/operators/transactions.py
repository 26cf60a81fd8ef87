"""Transactions: coercion, batches, data issues and the health scorecard."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from costledger.functions import numbers as N
from costledger.functions import text as X
from costledger.operators.numbering import running_before
from costledger.schemas import TRANSACTION, TRANSACTION_RAW, conform, rename_columns
from costledger.session import materialise
from costledger.sources.records import Prefixes

CHUNK_SIZE = 50_000
ISSUES_PER_BATCH = 5

# Fixed value: the header of the activity column in the exports.
SOURCE_HEADERS = {"Activity Level 3 Code and Name": "activity"}


def classify_transactions(
    raw: DataFrame, chunk_size: int = CHUNK_SIZE, renames: Mapping[str, str] | None = None
) -> DataFrame:
    """Typed transactions with their batch; rows without a code stay in, with a NULL ``tr_code``.

    ``src_row`` is the place of the row in the source; ``number_source`` adds it where the source has none.
    Amounts that do not read as a number and absent amount columns are 0, other absent columns NULL.
    """
    df = rename_columns(raw, {**SOURCE_HEADERS, **(renames or {})})
    for column in ("activity", "src_row"):
        if column not in [c.lower() for c in df.columns]:
            raise ValueError(f"Transaction data missing the {column} column.")
    df = conform(df, TRANSACTION_RAW)
    return df.select(
        X.extract_tr_code("activity").alias("tr_code"),
        F.col("activity").alias("account_name"),
        *[N.loose_number(c).alias(c) for c in ("debit", "credit", "net_amount")],
        N.whole_year("year").alias("year"),
        F.col("year").alias("year_text"),
        "month",
        F.col("journal_line_desc").alias("description"),
        F.floor(F.col("src_row") / chunk_size).cast("bigint").alias("batch_id"),
        "src_row",
    )


def valid_transactions(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("tr_code").isNotNull()).select(*TRANSACTION.names)


def data_issues(classified: DataFrame, limit: int = ISSUES_PER_BATCH) -> DataFrame:
    """The first bad rows of each batch: no code in the activity, or a year that is not a whole number."""
    return _first_per_batch(
        classified,
        [
            (F.col("tr_code").isNull(), "TR_Code", F.col("account_name"), "Extraction Failed"),
            (
                F.col("year").isNull() & ~X.is_blank("year_text"),
                "Year",
                F.col("year_text"),
                "Not a whole number",
            ),
        ],
        limit,
    )


def bad_row_sample(classified: DataFrame, limit: int = ISSUES_PER_BATCH) -> DataFrame:
    """The first rows of each batch without a code in the activity."""
    return _first_per_batch(
        classified, [(F.col("tr_code").isNull(), "TR_Code", F.col("account_name"), "Extraction Failed")], limit
    )


def _first_per_batch(classified: DataFrame, checks: list, limit: int) -> DataFrame:
    issues = F.array_compact(
        F.array(
            *[
                F.when(
                    bad,
                    F.struct(F.lit(name).alias("column"), value.alias("value"), F.lit(issue).alias("issue")),
                )
                for bad, name, value, issue in checks
            ]
        )
    )
    rows = classified.select("batch_id", F.col("src_row").alias("row_idx"), F.inline(issues))
    # Spark keeps the first rows of each group before the shuffle, so batches arrive with a few rows per task
    rank = F.row_number().over(W.partitionBy("batch_id", "column").orderBy("row_idx"))
    return rows.withColumn("_rank", rank).where(F.col("_rank") <= limit).drop("_rank")


def scorecard(classified: DataFrame) -> DataFrame:
    """Input rows, valid rows and the share kept in percent (0 without input)."""
    return classified.agg(
        F.count("*").alias("input_rows"), F.count("tr_code").alias("valid_rows")
    ).withColumn(
        "retention_pct",
        F.coalesce(F.try_divide(F.col("valid_rows"), F.col("input_rows")) * 100.0, F.lit(0.0)),
    )


def batch_totals(classified: DataFrame, count_all: bool = False) -> DataFrame:
    """Rows per batch, and rows in all batches before it; ``count_all`` counts invalid rows too.

    The counts are stored, as the running total reads them twice.
    """
    counted = F.count("*") if count_all else F.count("tr_code")
    batches = materialise(classified.groupBy("batch_id").agg(counted.alias("n_rows")), "batches")
    return running_before(batches, "batch_id", "n_rows").withColumnRenamed("before", "rows_before")


def limit_batches(classified: DataFrame, dry_run_limit: int, count_all: bool = False) -> DataFrame:
    """Whole batches until the rows before one reach the limit; 0 keeps everything.

    Rows before a batch never shrink, so the first batch over the limit is one number to filter by.
    """
    if dry_run_limit <= 0:
        return classified
    first_over = _first_over(classified, dry_run_limit, count_all).scalar()
    return classified.where(F.col("batch_id") < F.coalesce(first_over, F.lit(2**63 - 1)))


def _first_over(classified: DataFrame, dry_run_limit: int, count_all: bool) -> DataFrame:
    """The first batch before which the limit is reached."""
    over = batch_totals(classified, count_all).where(F.col("rows_before") >= dry_run_limit)
    return over.agg(F.min("batch_id"))


def limited_batches(
    source: Prefixes, dry_run_limit: int, classify: Callable[[DataFrame], DataFrame], count_all: bool = False, first: int = 1
) -> tuple[DataFrame, int]:
    """Whole batches until the rows before one reach the limit, out of a source that is read only as far as that takes; and the number of its blocks read.

    ``classify`` gives rows their batch. A prefix is enough once a row of the first batch over the limit is in it, as then all batches
    before that are whole. If it is not, the next one is as long as the rows seen so far make likely, and twice as long at least.
    """
    blocks = first if dry_run_limit > 0 else source.total
    while True:
        blocks = min(blocks, source.total)
        classified = materialise(classify(source.rows(blocks)), "prefix")
        if dry_run_limit <= 0:
            return classified, blocks
        over = F.col("rows_before") >= dry_run_limit
        found = batch_totals(classified, count_all).agg(F.min(F.when(over, F.col("batch_id"))).alias("first_over"), F.sum("n_rows").alias("n")).first()
        if found["first_over"] is not None:
            return classified.where(F.col("batch_id") < found["first_over"]), blocks
        if blocks == source.total:
            return classified, blocks
        likely = 5 * blocks * dry_run_limit // (4 * found["n"]) if found["n"] else 0
        blocks = max(2 * blocks, min(8 * blocks, likely + 1))
