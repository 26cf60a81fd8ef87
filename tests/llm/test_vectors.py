import math

import numpy as np
import pytest

from costledger.llm import queries, topk, vector_dedup

VECTORS = "vec_id long, embedding array<float>, label int, vector string, rep long, score int, rank int"


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, 1, "x", 2, 3, 4) for i, v in rows], VECTORS.replace("float", kind))


def groups(seed, n=500, length=64, spread=0.01):
    draw = np.random.default_rng(seed)
    centers = draw.normal(size=(n // 3, length))
    rows = [*centers, *(centers[draw.integers(0, 12)] + draw.normal(size=length) * spread for _ in range(n - len(centers)))]
    return [(int(i), [float(np.float32(x)) for x in v]) for i, v in zip(draw.permutation(10 * n)[:n], rows, strict=True)]


def plain_links(rows):
    """Id -> (number of links, smallest id reachable)."""
    good = [(i, np.array(v, dtype=np.float64)) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    parent, links = {i: i for i, _ in rows}, {i: 0 for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(good):
        for j, b in good[k + 1 :]:
            if len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.95:
                links[i] += 1
                links[j] += 1
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: (links[i], root(i)) for i, _ in rows}


def near(spark, rows, kind="float"):
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vector_dedup.near_vectors(frame(spark, rows, kind)).collect()}


@pytest.mark.parametrize("block", [2048, 40])
def test_near_vectors_equal_a_plain_version(spark, monkeypatch, block):
    monkeypatch.setattr(vector_dedup, "BLOCK", block)  # read by the driver
    rows = groups(4)
    assert near(spark, rows) == plain_links(rows)


def test_recall_at_the_threshold(spark):
    """Pairs with a cosine of 0.95 to 0.96: the hardest ones that must be found."""
    draw, rows = np.random.default_rng(8), []
    for k in range(400):
        a = draw.normal(size=64)
        a /= np.linalg.norm(a)
        side = draw.normal(size=64)
        side -= side @ a * a
        side /= np.linalg.norm(side)
        cosine = draw.uniform(0.9505, 0.96)
        rows += [(2 * k, a.tolist()), (2 * k + 1, (cosine * a + math.sqrt(1 - cosine**2) * side).tolist())]
    found = near(spark, rows, "double")
    assert sum(found[2 * k][0] >= 1 for k in range(400)) >= 0.98 * 400


def test_odd_vectors(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 3.0]), (5, [float("nan"), 1.0, 1.0]), (6, [float("inf"), 1.0, 1.0]), (7, v), (8, v), (9, [2.0, 4.0, 6.0]), (10, [1.0, 2.0]), (11, [1.0, 2.0, 3.0, 0.0]), (12, [-1.0, -2.0, -3.0]), (13, [-0.0, 1.0]), (14, [0.0, 1.0])]
    assert near(spark, rows, "double") == plain_links(rows)
    big = [(1, [1e300, 1e300]), (2, [1e300, 1.1e300]), (3, [1e-300, 1e-300])]
    assert {i: n for i, (n, _) in near(spark, big, "double").items()} == {1: 2, 2: 2, 3: 2}


def test_copies_null_ids_and_empty_table(spark):
    v, w = [1.0, 0.0, 0.0], [0.999, 0.01, 0.0]
    rows = [(i, v) for i in (5, 3, 9)] + [(i, w) for i in (4, 8)] + [(3, v), (None, v)]
    found = vector_dedup.near_vectors(frame(spark, rows)).collect()
    assert sorted((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0, r["kept"]) for r in found) == [(0, 0, 0, True), (3, 5, 3, True), (3, 5, 3, True), (4, 5, 3, False), (5, 5, 3, False), (8, 5, 3, False), (9, 5, 3, False)]
    assert vector_dedup.near_vectors(frame(spark, [])).count() == 0


def test_plan_grows_with_the_logarithm():
    small, large = vector_dedup.Plan(50_000), vector_dedup.Plan(50_000_000)
    assert large.depth <= small.depth + 6 and small.collisions >= 15


def plain_top(rows, queries_, k):
    whole = {}
    for i, v in rows:
        if v and all(x is not None and math.isfinite(x) for x in v):
            whole.setdefault(i, []).append([math.floor(64 * x) for x in v])
    out = set()
    for q in queries_:
        for own in whole.get(q, []):
            scores = [(-sum(a * b for a, b in zip(own, v, strict=True)), i) for i, vs in whole.items() if i != q for v in vs if len(v) == len(own)]
            out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)}
    return out


def top(spark, rows, k=20, kind="float", every=5):
    vectors = frame(spark, rows, kind).select("vec_id", "embedding", "label", "score")
    return {tuple(r) for r in topk.top_k(vectors, vectors.where(f"vec_id % {every} = 0"), k).collect()}


@pytest.mark.parametrize(("shard", "block"), [(16384, 4096), (60, 20)])
def test_top_k_equals_a_plain_version(spark, monkeypatch, shard, block):
    monkeypatch.setattr(topk, "SHARD", shard)
    monkeypatch.setattr(topk, "QUERIES", block)
    rows = groups(6, 400, 16, 0.05)
    assert top(spark, rows) == plain_top(rows, [i for i, _ in rows if i % 5 == 0], 20)


def test_top_k_ties_go_to_the_smaller_id(spark):
    rows = [(i, [1.0, 1.0] if i % 3 else [1.0, 1.001]) for i in range(700)]
    assert top(spark, rows, every=50) == plain_top(rows, range(0, 700, 50), 20)


def test_top_k_of_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (5, None), (10, []), (15, [None, 1.0]), (20, [float("nan"), 1.0]), (1, [3.0, -1.0]), (2, [1.0]), (25, [1.0, 2.0, 3.0]), (3, [0.0, 0.0]), (4, [1e-5, -1e-5])]
    assert top(spark, rows, kind="double") == plain_top(rows, [0, 5, 10, 15, 20, 25], 20)
    large = [(0, [1e15, -3e14]), (5, [2e15 + 1, 7.0]), (1, [-1e15, 1e15])]
    limit = lambda s: max(-(2**63), min(2**63 - 1, s))
    assert top(spark, large, kind="double") == {(q, r, i, limit(s)) for q, r, i, s in plain_top(large, [0, 5], 20)}
    assert top(spark, []) == set()


@pytest.mark.parametrize(("shard", "block"), [(16384, 4096), (30, 4)])
def test_top_k_of_repeated_rows(spark, monkeypatch, shard, block):
    """Equal query rows are one query, different vectors of an id one each; repeated candidates count each."""
    monkeypatch.setattr(topk, "SHARD", shard)
    monkeypatch.setattr(topk, "QUERIES", block)
    rows = groups(9, 120, 8, 0.05)
    rows = [(i // 10, v) for i, v in rows]
    rows = rows + rows[:40] + [(i, [x + 0.5 for x in v]) for i, v in rows[:60]]
    vectors = frame(spark, rows).select("vec_id", "embedding")
    got = sorted(tuple(r) for r in topk.top_k(vectors, vectors.where("vec_id % 5 = 0"), 20).collect())
    whole = [(i, [math.floor(64 * x) for x in v]) for i, v in rows]
    want = []
    for q, own in sorted({(i, tuple(v)) for i, v in whole if i % 5 == 0}):
        scores = sorted((-sum(a * b for a, b in zip(own, v, strict=True)), i) for i, v in whole if i != q)[:20]
        want += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores, 1)]
    assert got == sorted(want)


def test_query_equals_a_plain_version(spark, sf):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in queries.op8_topk(spark, sf).collect()}
    assert got == plain_top(rows, [i for i, _ in rows if i % 20 == 0], 20)


def test_ball_tree_bounds_hold():
    draw = np.random.default_rng(3)
    points = draw.normal(size=(3000, 8))
    tree = topk.BallTree(points, np.arange(3000))
    for (first, last, *_), center, radius in zip(tree.nodes, tree.centers, tree.radii, strict=True):
        assert np.sqrt(((tree.points[first:last] - center) ** 2).sum(axis=1)).max() <= radius * (1 + 1e-12)
    assert sorted(tree.ids.tolist()) == list(range(3000))
