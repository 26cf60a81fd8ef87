import random

from pyspark.sql import functions as F

from costledger.operators.numbering import number_sorted, number_source, previous_value, running_before
from costledger.sources.delimited import read_delimited


def test_running_before(spark):
    rng = random.Random(1)
    rows = [(b, k, rng.randint(0, 9)) for b in "xy" for k in rng.sample(range(500), 200)]
    df = spark.createDataFrame(rows, "b string, k bigint, v bigint").repartition(4)
    got = {(r["b"], r["k"]): r["before"] for r in running_before(df, "k", "v", ["b"], block=16).collect()}
    assert got == {(b, k): sum(v for b2, k2, v in rows if b2 == b and k2 < k) for b, k, _ in rows}


def test_number_sorted(spark):
    values = random.Random(2).sample(range(10_000), 3000)
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(7)
    got = {r["v"]: r["n"] for r in number_sorted(df, ["v"], "n", start=1).collect()}
    assert got == {v: i for i, v in enumerate(sorted(values), 1)}


def _write_files(folder):
    folder.mkdir()
    rows = []
    for name, count in (("b.csv", 400), ("a.csv", 1500), ("c.csv", 3)):
        lines = [f"{name}-{i}" for i in range(count)]
        (folder / name).write_text("v\n" + "\n".join(lines) + "\n")
        rows.append((name, lines))
    return [line for _, lines in sorted(rows) for line in lines]


def test_number_source_follows_files(spark, tmp_path):
    want = _write_files(tmp_path / "in")
    # small splits, packed into tasks by size and not by name
    for key, value in (("spark.sql.files.maxPartitionBytes", "2k"), ("spark.sql.files.openCostInBytes", "100")):
        spark.conf.set(key, value)
    try:
        scan = read_delimited(spark, str(tmp_path / "in"), encoding="UTF-8", keep_source=True)
        assert scan.rdd.getNumPartitions() > 3
        got = {r["n"]: r["v"] for r in number_source(scan, "n").collect()}
        per_file = number_source(spark.read.csv(str(tmp_path / "in"), header=True), "n", per_file=True, start=2)
        firsts = per_file.groupBy("source_file").agg(F.min("n"), F.max("n"), F.count("*")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [got[i] for i in range(len(want))] == want
    assert sorted((r[1], r[2] - r[3]) for r in firsts) == [(2, 1)] * 3


def test_number_source_parquet(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(1000).repartitionByRange(5, "id").sortWithinPartitions("id").write.parquet(path)
    rows = number_source(spark.read.parquet(path), "n").collect()
    assert all(r["id"] == r["n"] for r in rows) and len(rows) == 1000
    plan = number_source(spark.read.parquet(path), "n")._jdf.queryExecution().toString()
    assert "row_index" in plan


def test_previous_value_over_blocks(spark):
    rng = random.Random(3)
    rows = [(f, n, rng.randint(0, 99)) for f in ("one", "two") for n in sorted(rng.sample(range(2000), 300))]
    df = spark.createDataFrame(rows, "f string, n bigint, v int").repartition(4)
    got = {(r["f"], r["n"]): r["previous"] for r in previous_value(df, "f", "n", "v", block=8).collect()}
    want, last = {}, {}
    for f, n, v in rows:
        want[(f, n)] = last.get(f)
        last[f] = v
    assert got == want
