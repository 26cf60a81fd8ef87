"""Output tables: CSV with a header for exchange, Parquet for tables that jobs read again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costledger.functions.cost import anchor_text
from costledger.operators.bands import band_summary, rounded_bands
from costledger.operators.contract import COUNTER_LABELS
from costledger.schemas import LEDGER_COLUMNS
from costledger.sinks import versions

NO_BANDS = "No finite, positive School-Year cost-per-student values available for fuzzy banding."


def write_csv(df: DataFrame, path: str, order: Sequence[Column | str] = (), mode: str = "overwrite") -> None:
    """CSV with header, text kept as it is; ``order`` sorts by range, so part files follow each other."""
    ordered = df.orderBy(*order) if order else df
    (
        ordered.write.mode(mode)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_ledger(ledger: DataFrame, path: str) -> None:
    write_csv(ledger.select(*LEDGER_COLUMNS), path)


def write_spenders(spenders: DataFrame, path: str) -> None:
    """Highest net first; equal sums by staff."""
    order = [F.desc("total_net_spend"), "staff_id", "first_name", "family_name", "email"]
    write_csv(spenders, path, order)


def write_monthly_trends(trends: DataFrame, path: str) -> None:
    """Latest year first, then months as text, falling."""
    write_csv(trends, path, [F.desc("year"), F.desc("month")])


def write_account_summary(accounts: DataFrame, path: str) -> None:
    write_csv(accounts, path, [F.desc("total_net_spend"), "account_name"])


def write_statements(statements: DataFrame, path: str, folder_per_staff: bool = False) -> None:
    """Statements one after the other, each closed by its TOTAL row.

    Sorted by range on the row as well, so the rows of one member of staff may fill several files. A folder per
    staff id is for small numbers of staff; otherwise the sort order lets readers skip to one statement.
    """
    ordered = statements.orderBy("staff_id", "is_total", "batch_id", "src_row")
    writer = ordered.write.mode("overwrite")
    if folder_per_staff:
        writer = writer.partitionBy("staff_id")
    writer.parquet(path)


def write_messages(messages: DataFrame, path: str) -> None:
    messages.write.mode("overwrite").parquet(path)


def write_redacted(redacted: DataFrame, path: str) -> None:
    write_csv(redacted, path)


def write_data_issues(issues: DataFrame, path: str) -> None:
    write_csv(issues, path, ["batch_id", "row_idx"])


def replace_reference(reference: DataFrame, path: str) -> None:
    """Replace the stored reference as a whole; until that is done, readers see the old one."""
    versions.replace(reference, path)


def append_transactions(transactions: DataFrame, path: str, key: str) -> bool:
    """Add one load of transactions, named by ``key``; a load that is stored already is not stored again."""
    return versions.append(transactions, path, key)


def append_run_log(spark: SparkSession, path: str, source: str, output: str, sha256: str, run_id: str) -> bool:
    """One line per run, however often its job is tried."""
    line = spark.createDataFrame([("OK", source, output, sha256)], "status string, input string, output string, sha256 string")
    return versions.append(line.coalesce(1), path, run_id)


def processing_summary(
    counters: DataFrame, anchors: DataFrame, sha256: str, sheet: str = "", header_row: int = 0
) -> DataFrame:
    """Labels and values of a run in their order: fingerprint, source, counters, then a line per year."""
    spark = counters.sparkSession
    labels = {name: (i + 3, label) for i, (name, label) in enumerate(COUNTER_LABELS.items())}
    head = spark.createDataFrame(
        [(0, "Input file SHA-256", sha256), (1, "Input sheet", sheet), (2, "Header row (1-based)", str(header_row))],
        "ord int, label string, value string",
    )
    ord_of = F.create_map(*[F.lit(x) for name, (i, _) in labels.items() for x in (name, i)])
    label_of = F.create_map(*[F.lit(x) for name, (_, label) in labels.items() for x in (name, label)])
    body = counters.select(
        ord_of[F.col("metric")].alias("ord"), label_of[F.col("metric")].alias("label"), F.col("value").cast("string")
    )
    text = anchor_text(F.col("anchor_min"), F.col("anchor_median"), F.col("anchor_max"))
    tail = anchors.select((F.col("year") + 1000).alias("ord"), F.col("year").cast("string").alias("label"), text.alias("value"))
    return head.unionByName(body).unionByName(tail)


def write_processing_summary(summary: DataFrame, path: str) -> None:
    write_csv(summary, path, ["ord"])


def write_trend_matrix(matrix: DataFrame, path: str) -> None:
    write_csv(matrix, path, ["school"])


def write_subject_report(report: DataFrame, path: str) -> None:
    write_csv(report, path, ["school", "subject_no", "subject"])


def write_bands(bands: DataFrame, path: str, summary_path: str, notice_path: str) -> None:
    """Bands and their yearly counts; without any band, a notice besides the two empty tables."""
    write_csv(rounded_bands(bands), path, ["school", "year"])
    write_csv(band_summary(bands), summary_path, ["year"])
    if bands.isEmpty():
        write_csv(bands.sparkSession.createDataFrame([(NO_BANDS,)], "notice string"), notice_path)
