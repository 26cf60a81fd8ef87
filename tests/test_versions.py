import pytest

from costledger.operators import transactions as TX
from costledger.plans import jobs
from costledger.session import materialise
from costledger.sinks import tables as sink
from costledger.sinks import versions
from costledger.sources import records


def table(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "x long")


def content(spark, path):
    return sorted(r["x"] for r in versions.read_table(spark, path).collect())


def test_replace_and_append(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        versions.read_table(spark, path)
    assert versions.read_table(spark, path, table(spark, [1]).schema).count() == 0
    assert versions.append(table(spark, [1, 2]), path, "a") and versions.append(table(spark, [3]), path, "b")
    assert not versions.append(table(spark, [1, 2]), path, "a")
    assert content(spark, path) == [1, 2, 3]
    versions.replace(versions.read_table(spark, path).where("x > 1"), path)  # reads what it replaces
    assert content(spark, path) == [2, 3]
    assert versions.append(table(spark, [1, 2]), path, "a")
    assert content(spark, path) == [1, 2, 2, 3]
    versions.replace(table(spark, []), path)
    assert content(spark, path) == [] and versions.unused(spark, path).count() >= 4


def test_a_write_that_dies_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace(table(spark, range(100)), path)
    broken = table(spark, range(50)).repartition(4).selectExpr("if(x = 37, raise_error('died'), x) AS x")
    for write in (versions.replace, lambda df, p: versions.append(df, p, "k")):
        with pytest.raises(Exception, match="died"):
            write(broken, path)
        assert content(spark, path) == list(range(100))
    # data without its commit, and a commit that was not finished
    table(spark, [7]).write.parquet(f"{path}/data/{'f' * 32}")
    (tmp_path / "t" / "log" / "000000000009-x" / "_temporary" / "0").mkdir(parents=True)
    assert content(spark, path) == list(range(100))
    versions.replace(table(spark, [5]), path)
    assert content(spark, path) == [5]


def test_a_job_that_is_tried_again_logs_one_line(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("School,Subject No,Subject,Teaching Session,Incl Oncosts,Student Count\nNorth,1,Maths,Autumn 2024,100,4\n")
    for run in ("one", "one", "two"):
        jobs.contract_costs_of_file(spark, str(path), str(tmp_path / "out"), run_id=run)
    log = versions.read_table(spark, str(tmp_path / "out" / "run_log")).collect()
    assert [(r["status"], r["input"]) for r in log] == [("OK", str(path))] * 2


def transactions(tmp_path, n):
    lines = [f"{'x' if i % 4 == 0 else f'{1000000 + i}'},{i}.5,\"note\n{i}\"" for i in range(n)]
    (tmp_path / "tx.csv").write_text("\n".join(["activity,debit,journal_line_desc", *lines]), newline="")
    return str(tmp_path / "tx.csv")


@pytest.mark.parametrize(("limit", "count_all"), [(0, False), (75, False), (76, False), (101, True), (10_000, True)])
def test_limit_equals_the_limit_on_all_rows(spark, tmp_path, limit, count_all):
    path = transactions(tmp_path, 1000)
    classify = lambda rows: TX.classify_transactions(rows, 100)
    got, _ = TX.limited_batches(records.Prefixes(spark, path, block_bytes=2000), limit, classify, count_all)
    everything = materialise(classify(records.read_quoted(spark, path, number="src_row")), "all")
    want = TX.limit_batches(everything, limit, count_all)
    assert sorted(r["src_row"] for r in got.collect()) == sorted(r["src_row"] for r in want.collect())


def test_bytes_read_grow_with_the_limit_and_not_with_the_input(spark, tmp_path):
    classify = lambda rows: TX.classify_transactions(rows, 100)
    read = {}
    for n in (2000, 20_000):
        path = transactions(tmp_path, n)
        for limit in (75, 600):
            read[n, limit] = TX.limited_batches(records.Prefixes(spark, path, block_bytes=1000), limit, classify)[1]
    assert read[2000, 75] == read[20_000, 75] and read[2000, 600] == read[20_000, 600]
    assert read[2000, 75] < read[2000, 600] <= 64  # of some 500 blocks in the larger file


def test_job_over_files(spark, tmp_path):
    path = transactions(tmp_path, 1000)
    (tmp_path / "reference.csv").write_text("TR_Code,Staff_ID,First_Name,Family_Name,UTS_Email\n1000001,7,A,B,a@b.c\n1000999,8,C,D,c@d.e\n")
    for limit, ids in ((75, {"7"}), (0, {"7", "8"})):
        out = str(tmp_path / f"out{limit}")
        blocks = jobs.reconciliation_of_files(spark, path, str(tmp_path / "reference.csv"), out, 100, limit, block_bytes=1000, renames={"UTS_Email": "email"})
        assert {r["staff_id"] for r in spark.read.parquet(f"{out}/Statements").collect()} == ids
        assert (blocks < 10) == (limit > 0)
    assert sink.append_transactions(table(spark, [1]), str(tmp_path / "t"), "k")
