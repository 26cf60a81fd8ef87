import os
import shutil

from costledger.sources import records
from costledger.streaming.ingest import ingest_stream, read_ingested, read_transaction_stream

HEADERS = ("src_row,activity,debit,journal_line_desc", "journal_line_desc,debit,Activity Level 3 Code and Name,SRC_ROW", "note,activity,src_row,journal_line_desc")


def write(folder, n):
    os.makedirs(folder)
    for i in range(n):
        cells = {"activity": f"{1000000 + i} - X", "Activity Level 3 Code and Name": f"{1000000 + i} - X", "src_row": str(i), "SRC_ROW": str(i), "debit": "5", "journal_line_desc": f'"line\n{i}"', "note": "z"}
        header = HEADERS[i % 3]
        with open(f"{folder}/{i:04d}.csv", "w", newline="") as f:
            f.write(header + "\n" + ",".join(cells[c] for c in header.split(",")) + "\n")


def jobs_for(spark, folder, group):
    spark.sparkContext.setJobGroup(group, group)
    df, known = records.read_by_name(spark, folder)
    rows = df.collect()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return rows, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)), known.count()


def test_jobs_do_not_grow_with_files_and_headers(spark, tmp_path):
    write(tmp_path / "few", 3)
    write(tmp_path / "many", 120)
    few, few_jobs, _ = jobs_for(spark, str(tmp_path / "few"), "few")
    many, many_jobs, n_headers = jobs_for(spark, str(tmp_path / "many"), "many")
    assert (len(few), len(many), n_headers) == (3, 120, 120) and many_jobs <= few_jobs + 2
    assert {(r["src_row"], r["journal_line_desc"]) for r in many} == {(i, f"line\n{i}") for i in range(120)}
    assert sum(r["debit"] is None for r in many) == 40


def test_an_epoch_that_is_repeated_is_stored_once(spark, tmp_path):
    write(tmp_path / "in", 30)
    stored, progress = str(tmp_path / "stored"), str(tmp_path / "progress")
    run = lambda: ingest_stream(read_transaction_stream(spark, str(tmp_path / "in")), stored, progress).awaitTermination()
    run()
    # as after a failure between the store and the mark of the epoch
    shutil.rmtree(tmp_path / "progress" / "commits")
    run()
    rows = read_ingested(spark, stored).collect()
    assert sorted(r["src_row"] for r in rows) == list(range(30)) and {r["batch_id"] for r in rows} == {0}
