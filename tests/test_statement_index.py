import pytest
from pyspark.sql import functions as F

from costledger.sinks import statements as S
from costledger.sinks.tables import write_statements

SCHEMA = "staff_id string, is_total boolean, batch_id bigint, src_row bigint, net_amount double"


@pytest.fixture
def small_files(spark):
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "50")
    yield
    spark.conf.unset("spark.sql.files.maxRecordsPerFile")


def _rows(n_staff, hot=None):
    rows = [(f"{s:04d}", False, 1, s * 10 + i, 1.0) for s in range(n_staff) for i in range(3)]
    rows += [(f"{s:04d}", True, None, None, 3.0) for s in range(n_staff)]
    rows += [(hot, False, 2, 10_000 + i, 0.0) for i in range(400 if hot else 0)]
    return [*rows, (None, False, 3, 99_999, 5.0)]


def test_only_files_that_hold_the_id_are_read(spark, tmp_path, small_files, capsys):
    path = f"{tmp_path}/a folder/Statements"
    write_statements(spark.createDataFrame(_rows(200, "0077"), SCHEMA), path)
    S.index_statements(spark, path)
    stored = spark.read.parquet(path)
    n_files = len(stored.inputFiles())
    assert n_files > 15
    for staff_id in ("0000", "0077", "0199"):
        got = S.read_statement(spark, path, staff_id)
        want = stored.where(F.col("staff_id") == staff_id)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() >= 4
        holding = {r["f"] for r in want.select(F.col("_metadata.file_name").alias("f")).distinct().collect()}
        assert len(got.inputFiles()) == len(holding) < n_files
    got.explain("formatted")
    assert "EqualTo(staff_id,0199)" in capsys.readouterr().out
    assert S.read_statement(spark, path, "none").columns == stored.columns and S.read_statement(spark, path, "none").isEmpty()


def test_places_in_the_index(spark, tmp_path, small_files):
    path = f"{tmp_path}/Statements"
    write_statements(spark.createDataFrame(_rows(40), SCHEMA), path)
    S.index_statements(spark, path)
    rows = S.statement_index(spark, path).collect()
    assert sum(r["n_rows"] for r in rows) == 160 and all(r["last_row"] - r["first_row"] + 1 == r["n_rows"] for r in rows)


def test_an_index_of_other_files_is_not_used(spark, tmp_path):
    path = f"{tmp_path}/Statements"
    write_statements(spark.createDataFrame(_rows(5), SCHEMA), path)
    assert S.statement_index(spark, path) is None and S.read_statement(spark, path, "0003").count() == 4
    S.index_statements(spark, path)
    assert S.statement_index(spark, path) is not None
    write_statements(spark.createDataFrame([("0009", False, 1, 1, 1.0)], SCHEMA), path)
    assert S.statement_index(spark, path) is None
    assert S.read_statement(spark, path, "0009").count() == 1 and S.read_statement(spark, path, "0003").isEmpty()
