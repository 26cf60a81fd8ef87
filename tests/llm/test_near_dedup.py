import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from costledger.llm import near_dedup, queries
from costledger.llm.common import shingle_sets
from costledger.llm.graph import components

DOCS = "doc_id long, text string, rep long, n long, cluster long, count long, node long, component long, value long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    n = min(width, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def plain(docs, width):
    """Id -> (set size, smallest id reachable)."""
    sets = {i: shingles(t, width) for i, t in docs}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, 3, 4, 5, 6, 7) for i, t in rows], DOCS)


def run(spark, rows, width):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(frame(spark, rows), width).collect()}


def made(seed):
    """Groups of edited copies, copies in other letters, shared passages, short and empty texts."""
    draw, rows = random.Random(seed), []
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(draw.choice(words) for _ in range(40))
    for _ in range(25):
        base = [draw.choice(words) for _ in range(draw.choice([1, 3, 6, 30, 120]))]
        for _ in range(draw.choice([1, 2, 9])):
            copy = list(base)
            for _ in range(draw.randint(0, 1 + len(base) // 12)):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            text = draw.choice([" ", "\n", "\t "]).join(copy)
            rows.append(draw.choice([text, text, text.upper(), passage + " " + text]))
    rows += [None, "", " \t", "One", "one", "É é", "é É"]
    ids = draw.sample(range(10_000), len(rows))
    return list(zip(ids, rows, strict=True))


@pytest.mark.parametrize(("seed", "width"), [(1, 2), (2, 5)])
def test_equals_a_plain_version(spark, seed, width):
    rows = made(seed)
    assert run(spark, rows, width) == plain(rows, width)


def test_query_equals_a_plain_version(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r["doc_id"]: r for r in queries.op4_near_dedup(spark, sf).collect()}
    want = plain(rows, 2)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())


def test_large_group_in_blocks(spark, monkeypatch):
    # the blocks are chosen by the driver, so small ones can be set here
    monkeypatch.setattr(near_dedup, "LIST_BLOCK", 8)
    monkeypatch.setattr(near_dedup, "CLUSTER_BLOCK", 600)
    draw = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(90):
        copy = list(base)
        for _ in range(i % 9):
            copy[draw.randrange(60)] = f"x{draw.randrange(10_000)}"
        rows.append((i, " ".join(copy)))
    assert run(spark, rows, 2) == plain(rows, 2)


def test_null_ids_repeated_rows_and_empty_table(spark):
    rows = [(None, "a b c"), (None, "a b c"), (5, "a b c"), (5, "a b c"), (2, "a b c"), (7, None), (8, "x " * 60_000 + "y")]
    found = near_dedup.near_duplicates(frame(spark, rows), 2).collect()
    assert len(found) == len(rows)
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in found} == {(None, None, True), (5, 2, False), (2, 2, True), (7, 7, True), (8, 8, True)}
    assert near_dedup.near_duplicates(frame(spark, []), 2).count() == 0


def test_one_of_each_keeps_columns(spark):
    rows = [(None, "a b c"), (None, "a b c"), (5, "a b c"), (2, "a b c"), (2, "a b c"), (7, None), (9, "")]
    found = near_dedup.one_of_each(frame(spark, rows), 2)
    assert found.columns == frame(spark, rows).columns
    assert sorted((r["doc_id"] or 0) for r in found.collect()) == [0, 0, 2, 7, 9]


def test_components_of_random_graphs(spark):
    draw = random.Random(7)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1100)] + [(2000, i) for i in range(2001, 2080)] + [(5, 5)]
    parent = list(range(3000))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for e in edges if e[0] != e[1] for x in e}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab AÉé\t\n\x0b\x85", max_size=14)), max_size=6), st.integers(1, 5))
def test_shingle_sets(texts, width):
    found = list(shingle_sets(pa.array(texts, pa.string()), width))
    sets = [shingles(t, width) for t in texts]
    assert [len(f) for f in found] == [len(s) for s in sets]
    for a, f in zip(sets, found, strict=True):
        for b, g in zip(sets, found, strict=True):
            assert len(a & b) == len(np.intersect1d(f, g))


def test_estimates_of_held_sets_are_exact():
    draw = np.random.default_rng(2)
    for _ in range(50):
        a, b = (np.unique(draw.integers(0, 30, size=draw.integers(1, 20))) for _ in range(2))
        row = lambda s: np.concatenate((s, np.full(near_dedup.K - len(s), near_dedup.PAD)))[None, :]
        want = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert near_dedup.estimates(row(a), row(b))[0] == pytest.approx(want)


def test_different_texts_under_one_id(spark):
    first, second = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    near = first + " more"
    rows = [(5, first), (5, second), (5, second), (7, near), (9, second), (4, second + " x"), (8, "alone here now"), (8, None), (8, ""), (6, first), (6, near)]
    docs = spark.createDataFrame([(i, t, n, "m") for n, (i, t) in enumerate(rows)], "doc_id long, text string, mark int, component string")
    found = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(docs).collect()}
    # 60 words have 56 shingles, one more word one more
    assert found == {
        (5, 56, 5, True), (7, 57, 5, False), (6, 56, 5, False), (6, 57, 5, False),
        (5, 56, 4, False), (9, 56, 4, False), (4, 57, 4, True), (8, 1, 8, True), (8, 0, 8, True),
    }
    left = near_dedup.one_of_each(docs)
    assert left.schema == docs.schema
    kept = sorted((r["doc_id"], r["text"] or "") for r in left.collect())
    assert kept == sorted([(5, first), (4, second + " x"), (8, "alone here now"), (8, ""), (8, "")])


def test_near_texts_under_one_id_leave_one(spark):
    text = " ".join(f"c{i}" for i in range(80))
    docs = spark.createDataFrame([(3, text), (3, text + " end"), (3, text), (3, "other words of another text")], "doc_id long, text string")
    assert {r["component_id"] for r in near_dedup.near_duplicates(docs).collect()} == {3}
    left = [r["text"] for r in near_dedup.one_of_each(docs).collect()]
    assert len(left) == 2 and "other words of another text" in left
