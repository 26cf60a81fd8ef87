import os
from hashlib import sha256

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from costledger.operators import validate as V
from costledger.plans import jobs, views
from costledger.plans.views import view
from costledger.schemas import LEDGER_COLUMNS
from costledger.sources.delimited import read_delimited
from costledger.streaming.ingest import ingest_stream, read_ingested, read_transaction_stream
from costledger.sinks import tables as sink
from costledger.sinks.versions import read_table


def test_contract_costs(spark, sf, tmp_path):
    out = str(tmp_path)
    jobs.contract_costs(view(spark, sf, views.CONTRACT_RAW), out, "abc", "in.csv", "Data", 5)
    jobs.contract_costs(view(spark, sf, views.CONTRACT_RAW), out, "abc", "in.csv", "Data", 5)
    summary = read_delimited(spark, f"{out}/processing_summary")
    assert summary.count() == 3 + 11 + 7
    assert summary.where("label = 'Input file SHA-256'").first()["value"] == "abc"
    assert read_delimited(spark, f"{out}/trend_analysis").columns == ["school", *map(str, range(1995, 2002))]
    assert len(read_delimited(spark, f"{out}/report").columns) == 3 + 3 * 7
    bands = read_delimited(spark, f"{out}/fuzzy_bands")
    assert bands.count() == int(read_delimited(spark, f"{out}/fuzzy_band_summary").agg(F.sum("total")).first()[0])
    assert not os.path.exists(f"{out}/fuzzy_notice")
    assert [tuple(r) for r in read_table(spark, f"{out}/run_log").collect()] == [("OK", "in.csv", out, "abc")] * 2


def test_contract_costs_of_an_export(spark, tmp_path):
    lines = ["Exported by finance,,,,,", ",,,,,", 'School , Subject No.,Subject,TEACHING  SESSION,"Incl. Oncosts",Student Count']
    lines += ["NA,1,Maths,Autumn 2020,$100,4", "None,1,Maths,Autumn 2020,50,5", "None,2,null,Autumn 2020,50,5"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "contracts_2020.csv").write_text("\n".join(lines) + "\n")
    jobs.contract_costs_of_file(spark, str(tmp_path / "in"), str(tmp_path / "out"), "contracts")
    summary = {r["label"]: r["value"] for r in read_delimited(spark, f"{tmp_path}/out/processing_summary").collect()}
    assert summary["Header row (1-based)"] == "3" and summary["Input file SHA-256"] == sha256((tmp_path / "in" / "contracts_2020.csv").read_bytes()).hexdigest()
    trends = read_delimited(spark, f"{tmp_path}/out/trend_analysis", missing=False)
    assert {(r["school"], float(r["2020"])) for r in trends.collect()} == {("NA", 25.0), ("None", 10.0)}
    raw = read_delimited(spark, f"{tmp_path}/in/contracts_2020.csv", missing=False)
    assert len(raw.columns) == 6


def test_contract_headers_in_other_spellings(spark, tmp_path):
    columns = ["School", "Subject No.", "Subject", "Teaching Session", "Incl. Oncosts", "Student Count"]
    raw = spark.createDataFrame([("A", "1", "S", "2020", "10", "2")], columns)
    jobs.contract_costs(raw, str(tmp_path))
    assert float(read_delimited(spark, f"{tmp_path}/trend_analysis").first()["2020"]) == 5.0


def test_contract_costs_without_rows(spark, sf, tmp_path):
    out = str(tmp_path)
    jobs.contract_costs(view(spark, sf, views.CONTRACT_RAW).where("false"), out)
    assert read_delimited(spark, f"{out}/fuzzy_notice").first()[0] == sink.NO_BANDS


@pytest.fixture(scope="module")
def package(spark, sf, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("package"))
    raw, ref = view(spark, sf, views.TRANSACTIONS_RAW), view(spark, sf, views.REFERENCE_RAW)
    jobs.reconciliation(raw, ref, out, chunk_size=100)
    return out


def test_reconciliation_passes_its_own_validation(spark, package):
    found = jobs.validation(spark, package)
    assert found.collect() == []
    assert V.verdict(found).first()["verdict"] == "PASS"
    assert read_delimited(spark, f"{package}/Transaction_Ledger").columns == LEDGER_COLUMNS
    assert spark.read.parquet(f"{package}/Messages").count() == spark.read.parquet(f"{package}/Statements").where("is_total").count()


def test_validation_finds_what_is_wrong(spark, package, tmp_path):
    broken = str(tmp_path)
    spenders = read_delimited(spark, f"{package}/All_Spenders")
    sink.write_csv(spenders, f"{broken}/All_Spenders", [F.col("total_net_spend").cast("double")])
    spark.read.parquet(f"{package}/Statements").where("not is_total").write.parquet(f"{broken}/Statements")
    rules = {r["rule"] for r in jobs.validation(spark, broken).collect()}
    assert rules == {"missing table", "not sorted", "no total"}


def test_statements_by_folder(spark, sf, tmp_path):
    raw = view(spark, sf, views.TRANSACTIONS_RAW)
    ref = view(spark, sf, views.REFERENCE_RAW).where("cast(tr_code as int) < 6")
    jobs.reconciliation(raw, ref, str(tmp_path), chunk_size=100, dry_run_limit=500, folder_per_staff=True)
    staff = sorted(d for d in os.listdir(tmp_path / "Statements") if d.startswith("staff_id="))
    assert staff and all(s.startswith("staff_id=900") for s in staff)
    one = spark.read.parquet(str(tmp_path / "Statements" / staff[0]))
    assert one.where("is_total").count() == 1
    assert one.agg(F.max("batch_id")).first()[0] <= 5


def test_redaction(spark, sf, tmp_path):
    ref = view(spark, sf, views.REFERENCE_RAW)
    tx = view(spark, sf, views.TRANSACTIONS_RAW)
    path = str(tmp_path / "tx.parquet")
    tx.write.parquet(path)
    jobs.redaction(ref, {"Reference": ref}, str(tmp_path))
    jobs.redaction(ref, {"Data": spark.read.parquet(path)}, str(tmp_path), chunk_size=100, dry_run_limit=150)
    redacted = read_delimited(spark, f"{tmp_path}/Reference")
    assert redacted.where(F.col("first_name").startswith("Given")).count() == 0
    data = read_delimited(spark, f"{tmp_path}/Data")
    assert data.count() == 200 and data.columns == tx.columns


def test_validation_reads_every_table(spark, tmp_path):
    extra = spark.createDataFrame([("bad", "x"), ("1234567", "y")], "tr_code string, note string")
    sink.write_csv(extra, str(tmp_path / "Extra"))
    (tmp_path / "Spending_by_Account.csv").write_text("account_name,net\na,1\n")
    found = sorted((r["file_key"], r["rule"]) for r in jobs.validation(spark, str(tmp_path)).collect())
    assert found == [("Extra", "tr_code"), ("Spending_by_Account", "columns"), *[("package", "missing table")] * 3]
    assert {r["rule"] for r in jobs.validation(spark, str(tmp_path / "nothing")).collect()} == {"missing table", "no package"}


def test_one_large_count_does_not_stop_the_job(spark):
    from costledger.operators import contract as K

    rows = [("A", "1", "S", "2020", "10", "9e18"), ("A", "1", "S", "2020", "10", "9e18"), ("B", "1", "S", "2020", "10", "4")]
    raw = spark.createDataFrame(rows, "school string, subject_no string, subject string, teaching_session string, incl_oncosts string, student_count string")
    got = {r["school"]: (r["total_students"], r["oncosts_per_student"], r["status"]) for r in K.school_year(K.accumulate(K.classify_rows(raw))).collect()}
    assert got == {"A": (None, 20 / 18e18, "OK"), "B": (4, 2.5, "OK")}


def test_stream_reads_columns_by_name(spark, tmp_path):
    incoming, stored, progress = (str(tmp_path / n) for n in ("incoming", "stored", "progress"))
    os.mkdir(incoming)
    with open(f"{incoming}/a.csv", "w") as f:
        f.write("src_row,activity,debit,credit\n0,1234567 - X,5,6\n")
    with open(f"{incoming}/b.csv", "w") as f:
        f.write("credit,debit,src_row,Activity Level 3 Code and Name\n6,5,1,1234567 - X\n")
    with open(f"{incoming}/c.csv", "w") as f:
        f.write("credit,debit,activity\n6,5,1234567 - X\n")
    ingest_stream(read_transaction_stream(spark, incoming), stored, progress).awaitTermination()
    rows = read_ingested(spark, stored).collect()
    assert len(rows) == 3 and {(r["debit"], r["credit"], r["tr_code"]) for r in rows} == {(5.0, 6.0, "1234567")}
    with open(f"{incoming}/d.csv", "w") as f:
        f.write("src_row,debit\n2,5\n")
    with pytest.raises(StreamingQueryException, match="activity"):
        ingest_stream(read_transaction_stream(spark, incoming), stored, progress).awaitTermination()


def test_renames_reach_the_transactions(spark, sf, tmp_path):
    raw = view(spark, sf, views.TRANSACTIONS_RAW).where("src_row < 400")
    jobs.reconciliation(raw.withColumnRenamed("debit", "Amount_Debit"), view(spark, sf, views.REFERENCE_RAW), str(tmp_path), renames={"Amount_Debit": "debit"})
    assert read_delimited(spark, f"{tmp_path}/Transaction_Ledger").agg(F.sum(F.col("debit").cast("double"))).first()[0] > 0


def test_stream(spark, sf, tmp_path):
    raw = view(spark, sf, views.TRANSACTIONS_RAW)
    incoming, stored, progress = (str(tmp_path / n) for n in ("incoming", "stored", "progress"))
    sink.write_csv(raw.where("src_row < 700"), incoming)
    ingest_stream(read_transaction_stream(spark, incoming), stored, progress).awaitTermination()
    sink.write_csv(raw.where("src_row >= 700"), incoming, mode="append")
    ingest_stream(read_transaction_stream(spark, incoming), stored, progress).awaitTermination()
    rows = read_ingested(spark, stored)
    assert {r[0] for r in rows.select("batch_id").distinct().collect()} == {0, 1}
    assert rows.where("src_row < 700").select("batch_id").distinct().count() == 1
    assert rows.count() == 1423 and rows.select("src_row").distinct().count() == 1423
