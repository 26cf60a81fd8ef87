"""The registered queries: each operator over the views of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costledger.functions import text as X
from costledger.operators import bands as B
from costledger.operators import contract as K
from costledger.operators import reconcile as R
from costledger.operators import shapes as S
from costledger.operators import transactions as TX
from costledger.operators import validate as V
from costledger.operators.numbering import number_source
from costledger.operators.redact import pii_dictionary, redact
from costledger.operators.reference import prepare_reference, reference_issues
from costledger.plans import views
from costledger.plans.views import view
from costledger.schemas import TRANSACTION, TRANSACTION_RAW, VIOLATION
from costledger.session import fresh_path, materialise
from costledger.sinks import tables as sink
from costledger.sinks.reference import append_reference, read_reference
from costledger.sinks.reference import stored_codes as repeated_codes
from costledger.sinks.statements import index_statements, read_statement
from costledger.sinks.versions import read_table
from costledger.sources import files as source_files
from costledger.sources.delimited import read_delimited
from costledger.sources.records import Prefixes, read_quoted
from costledger.sources.sheet import body_rows, locate_table
from costledger.streaming.ingest import ingest_stream, read_ingested, read_transaction_stream

Query = Callable[[SparkSession, str], DataFrame]

CHUNK = 1000
DRY_RUN_LIMIT = 5000


def _classified(spark, folder):
    return K.classify_rows(view(spark, folder, views.CONTRACT_RAW))


def _grouped(spark, folder):
    return K.accumulate(_classified(spark, folder))


def _schools(spark, folder):
    return K.school_year(_grouped(spark, folder))


def _stored_schools(spark, folder):
    # read several times by anchors and bands: grouped once
    return materialise(_schools(spark, folder), "school_years")


def _transactions(spark, folder):
    return TX.classify_transactions(view(spark, folder, views.TRANSACTIONS_RAW), CHUNK)


def _valid(spark, folder):
    return TX.valid_transactions(_transactions(spark, folder))


def _reference(spark, folder):
    return prepare_reference(view(spark, folder, views.REFERENCE_RAW))


def clean_rows(spark, folder):
    return K.clean_rows(_classified(spark, folder))


def drop_reasons(spark, folder):
    return _classified(spark, folder).groupBy("reason").agg(F.count("*").alias("n_rows"))


def quality_counters(spark, folder):
    return K.quality_counters(_grouped(spark, folder))


def subject_year(spark, folder):
    return K.subject_year(_grouped(spark, folder))


def school_year(spark, folder):
    return _schools(spark, folder)


def status_counts(spark, folder):
    grouped = materialise(_grouped(spark, folder), "contract_groups")
    return K.status_counts(K.subject_year(grouped), K.school_year(grouped))


def year_anchors(spark, folder):
    return B.year_anchors(_stored_schools(spark, folder))


def anchor_lines(spark, folder):
    return B.anchor_lines(B.year_anchors(_stored_schools(spark, folder)), 2)


def fuzzy_bands(spark, folder):
    schools = _stored_schools(spark, folder)
    return B.fuzzy_bands(schools, B.year_anchors(schools))


def rounded_bands(spark, folder):
    return B.rounded_bands(fuzzy_bands(spark, folder))


def band_summary(spark, folder):
    return B.band_summary(fuzzy_bands(spark, folder))


def trend_matrix(spark, folder):
    return S.trend_matrix(_stored_schools(spark, folder))


def subject_report(spark, folder):
    return S.subject_report(materialise(K.subject_year(_grouped(spark, folder)), "subject_years"))


def _contract_export(spark, folder) -> str:
    """Folder with the contract rows as sorted lines, a file for each subject."""
    path = fresh_path(spark, "contract_export")
    lines = view(spark, folder, views.CONTRACT_LINES).repartition("subject_no")
    lines.sortWithinPartitions("subject_no", "line").write.partitionBy("subject_no").text(path)
    return path


def file_digests(spark, folder):
    found = source_files.fingerprints(spark, _contract_export(spark, folder) + "/subject_no=*")
    return found.select(F.regexp_extract("path", "subject_no=([0-9]+)", 1).alias("subject_no"), "length", "sha256")


def quoted_records(spark, folder):
    path = fresh_path(spark, "remarks")
    remarks = view(spark, folder, views.REMARKS)
    for part, encoding in (("latin", "ISO-8859-1"), ("utf8", "UTF-8")):
        rows = remarks.where(F.col("part") == part).orderBy("o_orderkey").select("o_orderkey", "remark", "amount")
        rows.write.option("header", True).option("quote", '"').option("escape", '"').option("encoding", encoding).csv(f"{path}/{part}")
    # small blocks, so that most of them begin within a file
    return read_quoted(spark, f"{path}/*", number="src_row", block_bytes=100_000).drop("source_file")


def processing_summary(spark, folder):
    sha256 = source_files.input_fingerprint(spark, _contract_export(spark, folder) + "/subject_no=*")
    grouped = materialise(_grouped(spark, folder), "contract_groups")
    anchors = B.year_anchors(materialise(K.school_year(grouped), "school_years"))
    found = locate_table(view(spark, folder, views.RAW_SHEET)).first()
    return sink.processing_summary(K.quality_counters(grouped), anchors, sha256, found["sheet"], found["header_row"])


def reference_clean(spark, folder):
    return _reference(spark, folder)


def reference_issues_query(spark, folder):
    return reference_issues(view(spark, folder, views.REFERENCE_FAULTY))


def tx_clean(spark, folder):
    return _valid(spark, folder)


def tx_year_text(spark, folder):
    classified = TX.classify_transactions(view(spark, folder, views.TRANSACTIONS_TEXT), CHUNK)
    return TX.valid_transactions(classified).select("src_row", "year", "month")


def bad_row_sample(spark, folder):
    return TX.bad_row_sample(_transactions(spark, folder))


def data_issues(spark, folder):
    return TX.data_issues(TX.classify_transactions(view(spark, folder, views.TRANSACTIONS_TEXT), CHUNK))


def scorecard(spark, folder):
    return TX.scorecard(_transactions(spark, folder))


def batch_totals(spark, folder):
    return TX.batch_totals(_transactions(spark, folder))


def dry_run_batches(spark, folder):
    kept = TX.limit_batches(_transactions(spark, folder), DRY_RUN_LIMIT)
    return kept.groupBy("batch_id").agg(F.count("*").alias("n_rows"), F.count("tr_code").alias("n_valid"))


def dry_run_files(spark, folder):
    """The same batches out of files that are read from their start, only as far as the limit takes."""
    path = fresh_path(spark, "transactions.csv")
    sink.write_csv(view(spark, folder, views.TRANSACTIONS_RAW).withColumnRenamed("src_row", "journal_no"), path, ["journal_no"])
    classify = lambda rows: TX.classify_transactions(rows, CHUNK)
    kept, _ = TX.limited_batches(Prefixes(spark, path, block_bytes=100_000), DRY_RUN_LIMIT, classify)
    return kept.groupBy("batch_id").agg(F.count("*").alias("n_rows"), F.count("tr_code").alias("n_valid"))


def replaced_reference(spark, folder):
    """A reference that was loaded twice, read while a third load has not been committed."""
    path = fresh_path(spark, "reference_table")
    reference = _reference(spark, folder)
    sink.replace_reference(reference.limit(3), path)
    sink.replace_reference(reference, path)
    reference.limit(5).write.parquet(f"{path}/data/{'0' * 32}")
    return read_table(spark, path)


def stored_codes(spark, folder):
    """Codes of the whole reference that an earlier load, of its even codes, has stored."""
    path = fresh_path(spark, "reference_loads")
    reference = _reference(spark, folder)
    append_reference(reference.where(F.col("tr_code").cast("long") % 2 == 0), path, "even")
    return repeated_codes(reference, path)


def loaded_reference(spark, folder):
    """The reference out of two loads, the last one tried twice."""
    path = fresh_path(spark, "reference_loads")
    for load in (0, 1, 1):
        append_reference(_reference(spark, folder).where(F.col("tr_code").cast("long") % 2 == load), path, f"load {load}")
    return read_reference(spark, path)


def appended_transactions(spark, folder):
    """Three loads of transactions, each tried twice."""
    path = fresh_path(spark, "transaction_table")
    valid = materialise(_valid(spark, folder), "valid")
    for load in range(3):
        for _ in range(2):
            sink.append_transactions(valid.where(F.col("batch_id") % 3 == load), path, f"load {load}")
    return read_table(spark, path)


def source_batches(spark, folder):
    numbered = number_source(spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey"))
    batch = F.floor(F.col("src_row") / CHUNK).cast("bigint").alias("batch_id")
    return numbered.groupBy(batch).agg(
        F.count("*").alias("n_rows"), F.min("o_orderkey").alias("first_key"), F.sum("o_orderkey").alias("key_sum")
    )


def ledger(spark, folder):
    return R.ledger(_valid(spark, folder), _reference(spark, folder))


def spenders(spark, folder):
    return R.spenders(_valid(spark, folder), _reference(spark, folder))


def monthly_trends(spark, folder):
    return R.monthly_trends(_valid(spark, folder))


def account_summary(spark, folder):
    return R.account_summary(_valid(spark, folder))


def active_staff(spark, folder):
    return R.active_staff(_valid(spark, folder), _reference(spark, folder))


def staff_statement_one(spark, folder):
    return R.staff_statement(_valid(spark, folder), _reference(spark, folder), "9021")


def indexed_statement(spark, folder):
    """The same out of the statements of all staff, with its TOTAL row."""
    path = fresh_path(spark, "statements")
    sink.write_statements(R.statements(_valid(spark, folder), _reference(spark, folder)), path)
    index_statements(spark, path)
    return read_statement(spark, path, "9021").drop("src_row")


def staff_totals(spark, folder):
    return R.staff_totals(_valid(spark, folder), _reference(spark, folder))


def _placed(spark, path: str, columns: list[str]) -> DataFrame:
    """Place of each row in the files of a sorted output, with the columns it is sorted by."""
    return number_source(read_delimited(spark, path, encoding="UTF-8", keep_source=True), "place", start=1).select("place", *columns)


def sorted_spenders(spark, folder):
    path = fresh_path(spark, "spenders")
    sink.write_spenders(spenders(spark, folder), path)
    return _placed(spark, path, ["staff_id", "first_name", "family_name", "email"])


def sorted_trends(spark, folder):
    path = fresh_path(spark, "trends")
    sink.write_monthly_trends(monthly_trends(spark, folder), path)
    return _placed(spark, path, ["year", "month"])


def sorted_accounts(spark, folder):
    path = fresh_path(spark, "accounts")
    sink.write_account_summary(account_summary(spark, folder), path)
    return _placed(spark, path, ["account_name"])


def sorted_report(spark, folder):
    path = fresh_path(spark, "report")
    sink.write_subject_report(subject_report(spark, folder), path)
    return _placed(spark, path, ["school", "subject_no", "subject"])


def sorted_bands(spark, folder):
    path = fresh_path(spark, "bands")
    sink.write_bands(fuzzy_bands(spark, folder), path, fresh_path(spark, "summary"), fresh_path(spark, "notice"))
    return _placed(spark, path, ["school", "year"])


def sorted_statements(spark, folder):
    path = fresh_path(spark, "statements")
    sink.write_statements(R.statements(_valid(spark, folder), _reference(spark, folder)), path)
    return number_source(spark.read.parquet(path), "place", start=1).select("place", "staff_id", "is_total", "src_row")


def statements(spark, folder):
    return R.statements(_valid(spark, folder), _reference(spark, folder)).drop("src_row")


def messages(spark, folder):
    return R.messages(R.staff_totals(_valid(spark, folder), _reference(spark, folder)))


def dictionary_of_staff(spark, folder):
    return pii_dictionary(view(spark, folder, views.REFERENCE_RAW))


def dictionary_of_people(spark, folder):
    return pii_dictionary(view(spark, folder, views.PEOPLE_RAW))


def _redacted(spark, folder, people, table, key, **limit):
    texts = spark.read.parquet(f"{folder}/{table}.parquet").select(*key, "text")
    dictionary = materialise(pii_dictionary(view(spark, folder, people)), "dictionary")
    return redact(texts, dictionary, ["text"], **limit)


def redacted_documents(spark, folder):
    return _redacted(spark, folder, views.PEOPLE_WORDS, "documents", ["doc_id"])


def redacted_by_join(spark, folder):
    """The way of dictionaries that are too large to be sent to tasks."""
    return _redacted(spark, folder, views.PEOPLE_WORDS, "documents", ["doc_id"], max_broadcast_chars=1000)


def redacted_phrases(spark, folder):
    return _redacted(spark, folder, views.PEOPLE_PHRASES, "documents", ["doc_id"])


def redacted_conversations(spark, folder):
    return _redacted(spark, folder, views.PEOPLE_RAW, "conversations", ["conv_id", "turn"])


def redacted_reference(spark, folder):
    reference = view(spark, folder, views.REFERENCE_RAW)
    dictionary = materialise(pii_dictionary(reference), "dictionary")
    return redact(reference, dictionary)


def code_violations(spark, folder):
    return V.code_violations(view(spark, folder, views.SPENDER_FILES))


def order_violations(spark, folder):
    return V.amount_order_violations(view(spark, folder, views.SPENDER_FILES))


def month_order_violations(spark, folder):
    return V.month_order_violations(view(spark, folder, views.TREND_FILES))


def total_violations(spark, folder):
    return V.total_violations(view(spark, folder, views.STATEMENT_FILES))


def missing_tables(spark, folder):
    return V.missing_tables(view(spark, folder, views.PACKAGES))


def _all_violations(spark, folder):
    found = order_violations(spark, folder)
    for rule in (month_order_violations, total_violations, missing_tables):
        found = found.unionByName(rule(spark, folder))
    return found.select(*VIOLATION.names)


def first_messages(spark, folder):
    return V.first_messages(_all_violations(spark, folder))


def error_counts(spark, folder):
    return V.error_counts(_all_violations(spark, folder))


def verdict(spark, folder):
    return V.verdict(_all_violations(spark, folder))


def own_statements_verdict(spark, folder):
    """The statements of the reconciliation job, checked by the rule for totals: no violation expected."""
    rows = materialise(R.statements(_valid(spark, folder), _reference(spark, folder)), "statements")
    checked = rows.withColumnsRenamed({"staff_id": "file_key", "src_row": "row_num"})
    return V.verdict(V.total_violations(checked.drop("batch_id")))


def located_header(spark, folder):
    return locate_table(view(spark, folder, views.RAW_SHEET))


def positional_rows(spark, folder):
    sheet = view(spark, folder, views.RAW_SHEET)
    return body_rows(sheet, locate_table(sheet))


def header_names(spark, folder):
    sheet = view(spark, folder, views.RAW_SHEET)
    cells = sheet.select(F.explode(F.array(*[c for c in sheet.columns if c.startswith("_c")])).alias("cell"))
    return cells.select("cell", X.canonical_header("cell").alias("name"))


def csv_roundtrip(spark, folder):
    path = fresh_path(spark, "transactions.csv")
    sink.write_csv(view(spark, folder, views.TRANSACTIONS_RAW), path)
    return read_delimited(spark, path)


def stream_ingest(spark, folder):
    path = fresh_path(spark, "incoming")
    raw = view(spark, folder, views.TRANSACTIONS_RAW)
    # three headers: another order, another name of the activity, and columns that the job does not know
    shapes = (
        list(reversed(TRANSACTION_RAW.names)),
        [F.col("activity").alias("Activity Level 3 Code and Name"), *[c for c in TRANSACTION_RAW.names if c != "activity"]],
        [F.lit("x").alias("Remark"), *TRANSACTION_RAW.names, F.lit("y").alias("Ledger")],
    )
    for k, columns in enumerate(shapes):
        sink.write_csv(raw.where(F.col("src_row") % 3 == k).select(*columns), path, mode="append")
    output = fresh_path(spark, "ingested")
    ingest_stream(read_transaction_stream(spark, path), output, fresh_path(spark, "progress")).awaitTermination()
    return read_ingested(spark, output).select(*[c for c in TRANSACTION.names if c != "batch_id"])


def fingerprint(spark, folder):
    return source_files.fingerprints(spark, folder, "*.parquet")


QUERIES: dict[str, Query] = {
    "clean_rows": clean_rows,
    "drop_reasons": drop_reasons,
    "quality_counters": quality_counters,
    "subject_year": subject_year,
    "school_year": school_year,
    "status_counts": status_counts,
    "year_anchors": year_anchors,
    "anchor_lines": anchor_lines,
    "fuzzy_bands": fuzzy_bands,
    "rounded_bands": rounded_bands,
    "band_summary": band_summary,
    "trend_matrix": trend_matrix,
    "subject_report": subject_report,
    "processing_summary": processing_summary,
    "reference_clean": reference_clean,
    "reference_issues": reference_issues_query,
    "tx_clean": tx_clean,
    "tx_year_text": tx_year_text,
    "bad_row_sample": bad_row_sample,
    "data_issues": data_issues,
    "scorecard": scorecard,
    "batch_totals": batch_totals,
    "dry_run_batches": dry_run_batches,
    "dry_run_files": dry_run_files,
    "replaced_reference": replaced_reference,
    "stored_codes": stored_codes,
    "loaded_reference": loaded_reference,
    "appended_transactions": appended_transactions,
    "source_batches": source_batches,
    "ledger": ledger,
    "spenders": spenders,
    "monthly_trends": monthly_trends,
    "account_summary": account_summary,
    "active_staff": active_staff,
    "staff_statement_one": staff_statement_one,
    "indexed_statement": indexed_statement,
    "staff_totals": staff_totals,
    "statements": statements,
    "sorted_spenders": sorted_spenders,
    "sorted_trends": sorted_trends,
    "sorted_accounts": sorted_accounts,
    "sorted_report": sorted_report,
    "sorted_bands": sorted_bands,
    "sorted_statements": sorted_statements,
    "messages": messages,
    "pii_dictionary": dictionary_of_staff,
    "pii_dictionary_people": dictionary_of_people,
    "redacted_documents": redacted_documents,
    "redacted_by_join": redacted_by_join,
    "redacted_phrases": redacted_phrases,
    "redacted_conversations": redacted_conversations,
    "redacted_reference": redacted_reference,
    "code_violations": code_violations,
    "order_violations": order_violations,
    "month_order_violations": month_order_violations,
    "total_violations": total_violations,
    "missing_tables": missing_tables,
    "first_messages": first_messages,
    "error_counts": error_counts,
    "verdict": verdict,
    "own_statements_verdict": own_statements_verdict,
    "located_header": located_header,
    "positional_rows": positional_rows,
    "header_names": header_names,
    "csv_roundtrip": csv_roundtrip,
    "stream_ingest": stream_ingest,
    "fingerprint": fingerprint,
    "file_digests": file_digests,
    "quoted_records": quoted_records,
}
