import compare
import pytest

from costledger.llm import mixing, queries
from costledger.llm.oracle import ORACLE

DOCS = "doc_id long, text string, source string, size long, hash string, stratum int, source_size long, target int, whole int, mixing int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, "h", 2, 3, 4, 5, 6) for i, t, s in rows], DOCS)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, folder):
    assert compare.differences(queries.op9_mixing(spark, folder), compare.connect(folder), ORACLE["op9_mixing"]) == []


def test_words_come_near_the_targets(spark):
    rows = [(i, "w " * (1 + i % 37), "abc"[i % 3] if i % 5 else "a") for i in range(3000)]
    found = mixing.mix(frame(spark, rows)).groupBy("source_size", "target").agg({"taken": "sum", "repeats": "max"}).collect()
    assert len(found) == 3
    for r in found:
        assert abs(r["sum(taken)"] - r["target"]) <= 20 and r["max(repeats)"] <= 3


def test_small_documents_make_up_for_large_ones(spark):
    # by chance of the hash a document of 300 words is far off any budget; documents of one to three words are not
    rows = [(i, "w " * (300 if i % 50 == 0 else 1 + i % 3), "ab"[i % 3 == 0]) for i in range(6000)]
    found = mixing.mix(frame(spark, rows)).groupBy("source_size", "target").agg({"taken": "sum"}).collect()
    assert len(found) == 2
    for r in found:
        assert abs(r["sum(taken)"] - r["target"]) <= 2


def test_sources_of_the_tables_are_near_their_targets(spark):
    found = queries.op9_mixing(spark, "/root/testdata/sf0.01").groupBy("source_size", "target").agg({"taken": "sum"}).collect()
    # half of a document of the smallest stratum that can make up for the others; these have up to some 120 words
    assert len(found) == 20 and all(abs(r["sum(taken)"] - r["target"]) <= 60 for r in found)


def shared(spark, sizes, weights, cap, total):
    sources = spark.createDataFrame([(i, s, float(w)) for i, (s, w) in enumerate(zip(sizes, weights))], "i int, source_size long, weight double")
    return [r["target"] for r in mixing.shared(sources, cap, total).orderBy("i").collect()]


def plain_shares(sizes, weights, cap, total):
    """One full source after the other."""
    full = set()
    while len(full) < len(sizes):
        rest = total - sum(cap * sizes[i] for i in full)
        weight = sum(w for i, w in enumerate(weights) if i not in full)
        over = [i for i in range(len(sizes)) if i not in full and rest * weights[i] / weight > cap * sizes[i]]
        if not over:
            return [cap * s if i in full else rest * weights[i] / weight for i, s in enumerate(sizes)]
        full.add(min(over, key=lambda i: cap * sizes[i] / weights[i]))
    return [cap * s for s in sizes]


def test_shares_are_capped_and_shared_again(spark):
    assert shared(spark, [10, 10, 1000], [1, 2, 3], 3, 1020.0) == [30, 30, 960.0]
    assert shared(spark, [0, 0], [1, 1], 3, 0.0) == [0, 0]
    assert shared(spark, [4], [1], 3, 4.0) == [4.0]
    assert shared(spark, [], [], 3, 0.0) == []


def test_shares_of_many_sources(spark):
    sizes = [(i * i * i) % 977 for i in range(3000)]
    weights = [1 + i % 3 for i in range(3000)]
    assert shared(spark, sizes, weights, 3, float(sum(sizes))) == pytest.approx(plain_shares(sizes, weights, 3, sum(sizes)))


def test_smaller_budgets_take_subsets(spark):
    docs = frame(spark, [(i, "w " * (1 + i % 9), "ab"[i % 2]) for i in range(800)])
    taken = [{r["doc_id"] for r in mixing.mix(docs, share=s).where("repeats > 0").collect()} for s in (0.05, 0.2, 0.5)]
    # but for the document at each threshold
    assert len(taken[0] - taken[1]) <= 8 and len(taken[1] - taken[2]) <= 8 and len(taken[0]) < len(taken[1]) < len(taken[2])


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "x " * 50_000, "b"), (None, "p q", None), (4, "one two", None), (4, "one two", None), (5, " \t\n", "é"), (6, "é x y", "z")]
    found = mixing.mix(frame(spark, rows)).collect()
    sizes = sorted((r["doc_id"] or 0, r["size"]) for r in found)
    assert sizes == [(0, 2), (1, 0), (2, 0), (3, 50_000), (4, 2), (4, 2), (5, 0), (6, 2)]
    assert all(0 <= r["taken"] <= 3 * r["size"] and r["taken"] % max(1, r["size"]) == 0 for r in found)
    assert mixing.mix(frame(spark, [])).count() == 0


def test_documents_are_repeated_with_all_columns(spark):
    docs = frame(spark, [(i, "w " * (1 + i % 7), "ab"[i % 2] if i % 10 else "small") for i in range(500)])
    found = mixing.mixed_documents(docs)
    assert found.schema == docs.schema
    times = {r["doc_id"]: r["repeats"] for r in mixing.mix(docs).collect()}
    got = {r["doc_id"]: r["count"] for r in found.groupBy("doc_id").count().collect()}
    assert got == {i: n for i, n in times.items() if n}


def test_reruns_agree(spark):
    docs = frame(spark, [(i, "w " * (1 + i % 11), "ab"[i % 2]) for i in range(300)])
    first = {(r["doc_id"], r["taken"]) for r in mixing.mix(docs).collect()}
    assert first == {(r["doc_id"], r["taken"]) for r in mixing.mix(docs.repartition(7)).collect()}
