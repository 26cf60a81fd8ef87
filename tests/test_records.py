import hashlib
import random

import pytest
from pyspark.sql import functions as F

from costledger.plans import jobs
from costledger.sources import files, records
from costledger.sources.delimited import read_delimited


def cell(draw):
    text = "".join(draw.choice(["a", "é", "漢", "\n", '""', ",", " ", "\n\n"]) for _ in range(draw.randrange(6)))
    return f'"{text}"' if draw.random() < 0.6 or any(c in text for c in '\n",') else text


def rows(draw, n):
    lines = [f"{i},{cell(draw)},{cell(draw)}" + ("\n" if draw.random() < 0.1 else "") for i in range(n)]
    return "\n".join(["id,one,two", *lines])


def as_set(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("block", [7, 200, 1 << 20])
def test_equal_to_a_scan_by_one_task(spark, tmp_path, block):
    draw = random.Random(block)
    for k in range(3):
        (tmp_path / f"f{k}.csv").write_text(rows(draw, 60) + ("\n" if k else ""), encoding="utf-8", newline="")
    got = records.read_quoted(spark, str(tmp_path), block_bytes=block, number="src_row")
    want = read_delimited(spark, str(tmp_path), encoding="UTF-8", multi_line=True)
    assert got.columns == ["id", "one", "two", "source_file", "src_row"]
    assert as_set(got.select("id", "one", "two")) == as_set(want)
    placed = got.orderBy("src_row").select("src_row", "id", F.element_at(F.split("source_file", "/"), -1)).collect()
    assert [tuple(r) for r in placed] == [(60 * k + i, str(i), f"f{k}.csv") for k in range(3) for i in range(60)]


@pytest.mark.parametrize("block", [4, 5, 1 << 20])
def test_breaks_of_other_systems_and_marks(spark, tmp_path, block):
    (tmp_path / "a.csv").write_bytes(b'\xef\xbb\xbfx,"y\r\nz",x\r\n1,"a\r\nb",\r\n\r\n2,,"q""r"\r\n')
    got = records.read_quoted(spark, str(tmp_path), block_bytes=block, missing=False, number="n").orderBy("n")
    assert got.columns == ["x", "y\r\nz", "x2", "source_file", "n"]
    assert [tuple(r)[:3] + (r["n"],) for r in got.collect()] == [("1", "a\r\nb", None, 0), ("2", None, 'q"r', 1)]


@pytest.mark.parametrize("block", [4, 5, 1 << 20])
def test_each_file_has_its_own_encoding(spark, tmp_path, block):
    (tmp_path / "a.csv").write_bytes("x\nJosé 漢字\n".encode())
    (tmp_path / "b.csv").write_bytes("x\nJosé €\n".encode("cp1252"))
    got = records.read_quoted(spark, str(tmp_path), block_bytes=block, number="n").orderBy("n")
    assert [r["x"] for r in got.collect()] == ["José 漢字", "José €"]


def test_odd_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"x,y\n")
    (tmp_path / "b.csv").write_bytes(b"")
    got = records.read_quoted(spark, str(tmp_path))
    assert got.columns == ["x", "y"] and got.count() == 0
    (tmp_path / "c.csv").write_bytes(b'x,y\n1,"never closed\n2,z\n')
    assert [tuple(r) for r in records.read_quoted(spark, str(tmp_path), block_bytes=4).collect()] == [("1", "never closed\n2,z\n")]
    (tmp_path / "d.csv").write_bytes(b"x,z\n1,2\n")
    with pytest.raises(ValueError, match="different headers"):
        records.read_quoted(spark, str(tmp_path))


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("k,v\n" + "".join(f'{i},"line\n{i}"\n' for i in range(20_000)), newline="")
    df = records.read_quoted(spark, str(path), block_bytes=20_000, number="n")
    assert df.rdd.getNumPartitions() == -(-path.stat().st_size // 20_000)
    assert df.where(F.col("v") != F.concat(F.lit("line\n"), F.col("n"))).count() == 0 and df.count() == 20_000


def test_a_file_beyond_two_gigabytes_has_a_digest(spark, tmp_path):
    size = 3 * 1024**3 + 5
    with open(tmp_path / "large.csv", "wb") as file:
        file.truncate(size)  # sparse
    digest = hashlib.sha256()
    for _ in range(3 * 1024):
        digest.update(bytes(1024**2))
    digest.update(bytes(5))
    (tmp_path / "small.csv").write_bytes(b"abc")
    found = {r["name"]: (r["length"], r["sha256"]) for r in files.fingerprints(spark, str(tmp_path)).collect()}
    assert found == {"large.csv": (size, digest.hexdigest()), "small.csv": (3, hashlib.sha256(b"abc").hexdigest())}


def test_an_input_of_several_files_has_one_digest(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"abc")
    one = hashlib.sha256(b"abc").hexdigest()
    assert files.input_fingerprint(spark, str(tmp_path)) == one
    (tmp_path / "b.csv").write_bytes(b"x")
    two = hashlib.sha256(b"x").hexdigest()
    want = hashlib.sha256("\n".join(sorted([one, two])).encode()).hexdigest()
    assert files.input_fingerprint(spark, str(tmp_path)) == want


def test_the_contract_job_names_the_digest(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("School,Subject No,Subject,Teaching Session,Incl Oncosts,Student Count\nNorth,1,Maths,Autumn 2024,100,4\n")
    jobs.contract_costs_of_file(spark, str(path), str(tmp_path / "out"))
    digest = hashlib.sha256(path.read_bytes()).hexdigest()
    summary = read_delimited(spark, str(tmp_path / "out" / "processing_summary"), encoding="UTF-8", missing=False)
    assert summary.where("label = 'Input file SHA-256'").first()["value"] == digest
