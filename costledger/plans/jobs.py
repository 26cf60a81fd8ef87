"""The four jobs from input tables to output tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costledger.operators import bands as B
from costledger.operators import contract as K
from costledger.operators import reconcile as R
from costledger.operators import shapes as S
from costledger.operators import transactions as TX
from costledger.operators import validate as V
from costledger.operators.numbering import number_source
from costledger.operators.redact import pii_dictionary, redact
from costledger.operators.reference import check_reference, prepare_reference
from costledger.session import fit_shuffles, materialise
from costledger.sinks import tables as sink
from costledger.sinks.statements import index_statements
from costledger.sinks.versions import read_table
from costledger.sources.delimited import read_delimited, read_raw_cells
from costledger.sources.files import find_file, input_fingerprint, table_names
from costledger.sources.records import BLOCK_BYTES, Prefixes, read_quoted
from costledger.sources.sheet import body_rows, locate_table


def contract_costs_of_file(spark: SparkSession, path: str, output: str, pattern: str = "", run_id: str | None = None) -> None:
    """Reports out of an export as it is: the table is found below any notes, and its cells stay the texts they are.

    With a ``pattern`` the file is chosen in the folder ``path``. The summary names the file's fingerprint and the header's row.
    """
    path = find_file(spark, path, pattern, (".csv",)) if pattern else path
    name = path.rstrip("/").rsplit("/", 1)[-1]
    cells = number_source(read_raw_cells(spark, path), "row_idx", per_file=True, start=1)
    sheet = cells.withColumns({"sheet_ord": F.lit(1), "sheet": F.lit(name)})
    located = materialise(locate_table(sheet), "header")
    rows = body_rows(sheet, located)
    contract_costs(rows, output, input_fingerprint(spark, path), path, name, located.first()["header_row"], run_id)


def contract_costs(
    raw: DataFrame, output: str, sha256: str = "", source: str = "", sheet: str = "", header_row: int = 0,
    run_id: str | None = None,
) -> None:
    """Contract rows to reports. The rows are read once; everything derives from their grouped table.

    A job that is tried again under the same ``run_id`` leaves one line in the run log.

    Headers may be spelled as exports do, in any case and spacing.
    """
    spark = raw.sparkSession
    raw = K.known_headers(raw)
    fit_shuffles(raw)
    grouped = materialise(K.accumulate(K.classify_rows(raw)), "contract_groups")
    schools = materialise(K.school_year(grouped), "school_years")
    subjects = K.subject_year(grouped)
    anchors = materialise(B.year_anchors(schools), "anchors")
    years = S.known_years(schools)
    sink.write_processing_summary(
        sink.processing_summary(K.quality_counters(grouped), anchors, sha256, sheet, header_row),
        f"{output}/processing_summary",
    )
    sink.write_trend_matrix(S.trend_matrix(schools, years), f"{output}/trend_analysis")
    sink.write_subject_report(S.subject_report(subjects, years), f"{output}/report")
    sink.write_bands(
        B.fuzzy_bands(schools, anchors), f"{output}/fuzzy_bands", f"{output}/fuzzy_band_summary",
        f"{output}/fuzzy_notice",
    )
    sink.append_run_log(spark, f"{output}/run_log", source, output, sha256, run_id or uuid.uuid4().hex)


def reconciliation(
    transactions_raw: DataFrame,
    reference_raw: DataFrame,
    output: str,
    chunk_size: int = TX.CHUNK_SIZE,
    dry_run_limit: int = 0,
    letter: R.Letter = R.Letter(),
    folder_per_staff: bool = False,
    renames: Mapping[str, str] | None = None,
) -> None:
    """Ledger, summaries, statements, messages, data issues and scorecard.

    The coerced transactions are stored once and all outputs read them, each with the columns it needs.
    """
    fit_shuffles(transactions_raw, reference_raw)
    classified = materialise(TX.classify_transactions(transactions_raw, chunk_size, renames), "transactions")
    _reconciled(TX.limit_batches(classified, dry_run_limit), reference_raw, output, letter, folder_per_staff, renames)


def reconciliation_of_files(
    spark: SparkSession,
    transactions: str,
    reference: str,
    output: str,
    chunk_size: int = TX.CHUNK_SIZE,
    dry_run_limit: int = 0,
    letter: R.Letter = R.Letter(),
    folder_per_staff: bool = False,
    renames: Mapping[str, str] | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> int:
    """The reconciliation of delimited files, whose cells may hold line breaks.

    With a limit, the transactions are read from their start and only as far as the limit takes. Returns the number of blocks read.
    """
    people = read_quoted(spark, reference)
    source = Prefixes(spark, transactions, block_bytes=block_bytes)
    classified, blocks = TX.limited_batches(source, dry_run_limit, lambda rows: TX.classify_transactions(rows, chunk_size, renames))
    _reconciled(classified, people, output, letter, folder_per_staff, renames)
    return blocks


def _reconciled(
    classified: DataFrame, reference_raw: DataFrame, output: str, letter: R.Letter, folder_per_staff: bool, renames: Mapping[str, str] | None
) -> None:
    """All outputs of stored transactions; the reference is checked before anything is written."""
    spark = reference_raw.sparkSession
    check_reference(reference_raw, renames)
    sink.replace_reference(prepare_reference(reference_raw, renames), f"{output}/reference")
    reference = read_table(spark, f"{output}/reference")
    valid = TX.valid_transactions(classified)
    sink.write_data_issues(TX.data_issues(classified), f"{output}/data_issues")
    sink.write_ledger(R.ledger(valid, reference), f"{output}/Transaction_Ledger")
    sink.write_spenders(R.spenders(valid, reference), f"{output}/All_Spenders")
    sink.write_monthly_trends(R.monthly_trends(valid), f"{output}/Monthly_Trends")
    sink.write_account_summary(R.account_summary(valid), f"{output}/Spending_by_Account")
    totals = materialise(R.staff_totals(valid, reference), "staff_totals")
    sink.write_statements(R.statements(valid, reference, totals), f"{output}/Statements", folder_per_staff)
    if not folder_per_staff:
        index_statements(spark, f"{output}/Statements")
    sink.write_messages(R.messages(totals, letter), f"{output}/Messages")
    sink.write_csv(TX.scorecard(classified), f"{output}/scorecard")


def redaction(
    reference_raw: DataFrame,
    tables: Mapping[str, DataFrame],
    output: str,
    chunk_size: int = TX.CHUNK_SIZE,
    dry_run_limit: int = 0,
    renames: Mapping[str, str] | None = None,
) -> None:
    """Redacted copies of the tables, by a dictionary out of the reference.

    A limit keeps whole batches of each table, counting all rows; the tables must then be plain scans.
    """
    fit_shuffles(reference_raw, *tables.values())
    dictionary = materialise(pii_dictionary(reference_raw, renames), "dictionary")
    for name, table in tables.items():
        columns = table.columns
        if dry_run_limit > 0:
            batch = F.floor(F.col("_row") / chunk_size).cast("bigint")
            numbered = number_source(table, "_row").withColumn("batch_id", batch)
            table = TX.limit_batches(numbered, dry_run_limit, count_all=True).select(*columns)
        sink.write_redacted(redact(table, dictionary), f"{output}/{name}")


def validation(spark: SparkSession, package: str) -> DataFrame:
    """Violations of all tables that a package holds, read back from their files in file order.

    Of each table the columns that its rule reads are numbered and stored, and nothing else.
    """
    tables = {}
    for name in table_names(spark, package):
        scan = read_delimited(spark, f"{package}/{name}", encoding="UTF-8", missing=False, keep_source=True)
        key = name.rsplit(".", 1)[0]
        needed = [c for c in scan.columns if c.lower() in (*V.RULES.get(key, ({}, None))[0], "tr_code")]
        cells = scan.select(*(needed or scan.columns[:1]), "source_file", "source_split")
        tables[key] = number_source(cells, "row_num", start=2).drop("source_file")
    try:
        statements = spark.read.parquet(f"{package}/Statements")
        tables["Statements"] = statements.withColumnsRenamed({"staff_id": "file_key", "src_row": "row_num"})
    except AnalysisException:  # a package may have none
        pass
    return V.package_violations(spark, tables)
