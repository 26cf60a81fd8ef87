import random
from hashlib import sha256

import compare
import pytest
from pyspark.sql import functions as F

from costledger.llm import line_dedup, queries
from costledger.llm.oracle import ORACLE

DOCS = "doc_id long, text string, n_lines string, bitmap int, text_hash long, pos int, h1 long, n_chars long"
TRIM = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(TRIM).translate(LOWER)


def plain(rows, least):
    """(id, text) -> lines, lines dropped, text kept."""
    found = {}
    for doc in set(rows):
        for k in {key(x) for x in (doc[1] or "").split("\n")}:
            found.setdefault(k, set()).add((doc[0], doc[1] or ""))
    hot = {k for k, docs in found.items() if k and len(docs) >= least}
    out = {}
    for doc in rows:
        lines = (doc[1] or "").split("\n")
        kept = [x for x in lines if key(x) not in hot]
        out[doc] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def test_query_equals_sql(spark, sf):
    assert compare.differences(queries.op7_line_dedup(spark, sf), compare.connect(sf), ORACLE["op7_line_dedup"]) == []


def run(spark, rows, least):
    docs = spark.createDataFrame([(i, t, "x", 1, 2, 3, 4, 5) for i, t in rows], DOCS)
    marked = line_dedup.drop_repeated_lines(docs, least).withColumn("kept", line_dedup.kept_text("text", F.col("bitmap")))
    return sorted(((r["doc_id"], r["text"]), (r["n_lines"], r["n_dropped"], r["kept"])) for r in marked.where("doc_id IS NOT NULL").collect()), marked


@pytest.mark.parametrize("seed", range(2))
def test_random_documents(spark, seed):
    draw = random.Random(seed)
    pool = ["a", " A\t", "b", "", " ", "Ä", "ä", "x ", "\x1cq", "the line", "THE LINE ", "\r", "z" * 3000]
    rows = [(i, draw.choice([None, "", "\n".join(draw.choice(pool) for _ in range(draw.randint(1, 12)))])) for i in range(80)]
    rows = [(i, t) for i, t in rows] + rows[:9]
    got, _ = run(spark, rows, 10)
    want = plain(rows, 10)
    assert got == sorted((d, want[d]) for d in rows)


def test_repeated_rows_are_one_document(spark):
    rows = [(1, "same\nline")] * 12 + [(2, "same")]
    got, _ = run(spark, rows, 3)
    assert {d[1] for _, d in got} == {0}


def test_null_ids_clashing_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(None, f"hot\n{i}", "x", 1, 2, 3, 4, 5) for i in range(12)] + [(1, "hot", "x", 7, 2, 3, 4, 3)], DOCS)
    found = line_dedup.without_repeated_lines(docs)
    assert found.schema == docs.schema
    rows = {(r["doc_id"], r["text"], r["n_chars"]) for r in found.collect()}
    assert rows == {(None, str(i), len(str(i))) for i in range(12)} | {(1, "", 0)}
    assert line_dedup.drop_repeated_lines(docs.limit(0)).count() == 0


def test_bitmap_is_run_length_coded(spark):
    dropped = F.expr("CASE id WHEN 0 THEN array(1, 2, 5) WHEN 1 THEN array(0, 1, 2, 3, 4, 5, 6) ELSE CAST(array() AS array<int>) END")
    df = spark.range(3).select(line_dedup.keep_bitmap(dropped, F.lit(7)).alias("b"), "id").withColumn("r", line_dedup.bitmap_runs(F.col("b")))
    assert [[tuple(x) for x in r["r"]] for r in df.orderBy("id").collect()] == [[(0, 1), (3, 2), (6, 1)], [], [(0, 7)]]


def test_plan_is_native_and_the_window_adds_no_shuffle(spark, sf):
    plan = queries.op7_line_dedup(spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = line_dedup.first_occurrences(line_dedup.line_rows(docs), 4)._jdf.queryExecution().executedPlan().toString()
    assert found.count("Exchange") == 1 and "rangepartitioning" in found


def test_very_long_text(spark):
    text = "\n".join(["boiler"] * 20_000 + ["end"])
    got, _ = run(spark, [(i, f"{text}{i}") for i in range(10)], 10)
    assert got[0][1] == (20_001, 20_000, "end0") and sha256(got[0][1][2].encode()).hexdigest()
