import hashlib

import pytest

from costledger.operators.numbering import number_source
from costledger.schemas import CONTRACT_RAW
from costledger.sinks import tables as sink
from costledger.sources import files
from costledger.sources.delimited import check_suffix, read_delimited, read_raw_cells
from costledger.sources.sheet import body_rows, locate_table


def test_encoding_by_file(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿TR Code,n\n1,José\n".encode())
    (tmp_path / "b.csv").write_bytes("TR Code,n\n2,Zoë “€”\n".encode("cp1252"))
    rows = read_delimited(spark, str(tmp_path)).orderBy("`TR Code`").collect()
    assert [tuple(r) for r in rows] == [("1", "José"), ("2", "Zoë “€”")]
    rows = read_delimited(spark, str(tmp_path), keep_source=True)
    assert number_source(rows, "i").orderBy("i").select("i", "n").first()["n"] == "José"


def test_missing_texts_and_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\nNA,"x ""y"", z"\n nan ,\nnull,None\n')
    rows = read_delimited(spark, str(tmp_path / "a.csv")).collect()
    assert [tuple(r) for r in rows] == [(None, 'x "y", z'), (" nan ", None), (None, None)]


def test_unknown_type():
    check_suffix("/x/folder")
    check_suffix("/x/A.CSV")
    with pytest.raises(ValueError, match="Unsupported"):
        check_suffix("/x/a.xlsx")


def test_text_survives_a_round_trip(spark, tmp_path):
    rows = [(" padded ", 'say "hi", ok'), (None, "line\nbreak"), ("ü", "a\\b")]
    sink.write_csv(spark.createDataFrame(rows, "a string, b string").coalesce(1), str(tmp_path / "out"))
    back = read_delimited(spark, str(tmp_path / "out"), multi_line=True).collect()
    assert sorted(map(str, map(tuple, back))) == sorted(map(str, rows))


def test_file_choice(spark, tmp_path):
    for name in ("Reference_b.csv", "reference_a.csv", "Reference_Z.XLSM", "~$Reference.xlsx", "Reference.txt", "Other.xlsx"):
        (tmp_path / name).write_text("x")
    assert files.find_file(spark, str(tmp_path), "Reference").endswith("Reference_Z.XLSM")
    assert files.find_file(spark, str(tmp_path), "eference", (".csv",)).endswith("reference_a.csv")
    with pytest.raises(FileNotFoundError, match="Nothing"):
        files.find_file(spark, str(tmp_path), "Nothing")


def test_fingerprint(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"abc" * 1000)
    row = files.fingerprints(spark, str(tmp_path)).first()
    assert (row["name"], row["length"], row["sha256"]) == ("a.bin", 3000, hashlib.sha256(b"abc" * 1000).hexdigest())


SHEET = """Export,,,,,,
,,,,,,
School,Subject No.,Subject,,,,
x, subject  NUMBER ,Subject,Teaching Session,Incl. Oncosts,Student Count,SCHOOL
old,1,Maths,Autumn 2020,$5,2,A
old,2,Art
"""


def test_table_inside_a_file(spark, tmp_path):
    (tmp_path / "s.csv").write_text(SHEET)
    from pyspark.sql import functions as F

    cells = read_raw_cells(spark, str(tmp_path / "s.csv"), 10)
    sheet = number_source(cells, "row_idx", per_file=True, start=1).select(
        F.lit(1).alias("sheet_ord"), F.lit("s").alias("sheet"), "*"
    )
    located = locate_table(sheet)
    assert located.first().asDict() == {
        "sheet_ord": 1, "sheet": "s", "header_row": 4, "school": 6, "subject_no": 1, "subject": 2, "teaching_session": 3,
        "incl_oncosts": 4, "student_count": 5,
    }
    rows = body_rows(sheet, located)
    assert rows.columns == CONTRACT_RAW.names
    assert sorted(map(tuple, rows.collect()), key=str) == [
        ("A", "1", "Maths", "Autumn 2020", "$5", "2"), (None, "2", "Art", None, None, None),
    ]


def test_no_header(spark):
    sheet = spark.createDataFrame([(1, "s", 1, "School")], "sheet_ord int, sheet string, row_idx int, _c0 string")
    with pytest.raises(ValueError, match="Could not locate"):
        body_rows(sheet, locate_table(sheet))


def test_header_below_the_scanned_rows(spark):
    names = ["School", "Subject No", "Subject", "Teaching Session", "Incl Oncosts", "Student Count"]
    columns = ", ".join(f"_c{i} string" for i in range(6))
    sheet = spark.createDataFrame([(1, "s", 31, *names)], f"sheet_ord int, sheet string, row_idx int, {columns}")
    assert locate_table(sheet).first() is None
    assert locate_table(sheet, scan_rows=31).first()["header_row"] == 31
