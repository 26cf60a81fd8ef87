"""Transactions that arrive as files: the batch operators on a stream."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from costledger.operators.transactions import SOURCE_HEADERS, classify_transactions, valid_transactions
from costledger.schemas import TRANSACTION
from costledger.sinks.versions import append, read_table
from costledger.sources.records import read_by_name

FILES = "path string, modificationTime timestamp, length long, content binary"


def read_transaction_stream(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    """The CSV files as they arrive, by path; their content is read by name of its columns, see ``ingest_stream``."""
    files = spark.readStream.format("binaryFile").schema(FILES).option("maxFilesPerTrigger", max_files).load(folder)
    return files.select("path")  # the content is not selected, so it is not read


def ingest_stream(
    files: DataFrame,
    output: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    renames: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Store the valid transactions of each micro-batch of files, with the epoch as their batch.

    The headers of a trigger's files are read by one job, and its rows by name by another, however many files and headers there are.
    An epoch of a checkpoint is committed to the table once, so one that is repeated after a failure adds nothing. The coercions keep no
    state, hence no watermark. A file without an activity column raises.
    """

    def store(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        paths = [r["path"] for r in batch.select("path").collect()]  # at most maxFilesPerTrigger
        if not paths:
            return
        rows, headers = read_by_name(spark, paths)
        names = F.transform("names", lambda n: F.lower(n))
        accepted = ["activity", *(n.lower() for n, t in {**SOURCE_HEADERS, **(renames or {})}.items() if t == "activity")]
        lacking = headers.where(~F.arrays_overlap(names, F.lit(accepted))).first()
        if lacking is not None:
            raise ValueError(f"Transaction data missing the activity column: {lacking['path']}")
        for source, target in {**SOURCE_HEADERS, **(renames or {})}.items():  # files may differ in the name they use
            present = {c.lower(): c for c in rows.columns}
            if source.lower() in present and target.lower() in present and source.lower() != target.lower():
                rows = rows.withColumn(present[target.lower()], F.coalesce(f"`{present[target.lower()]}`", f"`{present[source.lower()]}`")).drop(present[source.lower()])
        typed = valid_transactions(classify_transactions(rows, renames=renames))
        append(typed.withColumn("batch_id", F.lit(epoch).cast("bigint")), output, f"{checkpoint} epoch {epoch}")

    return (
        files.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_ingested(spark: SparkSession, output: str) -> DataFrame:
    """What the stream has stored so far, in the columns of the batch job."""
    return read_table(spark, output, TRANSACTION).select(*TRANSACTION.names)
