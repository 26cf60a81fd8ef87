"""Exact top-k search by inner product: ball-tree branch and bound in each shard.

Candidates are dealt into shards of about ``SHARD`` vectors, queries into blocks of about ``QUERIES``; a task has one shard and one block, so both sides are
bounded at any size. It builds a ball tree of the shard and visits the nodes in the order of their upper bound (inner product with the centre plus
radius times the query's length), for all queries of the block together; a query leaves a node whose bound is below its current k-th
score. In a first round each query searches one shard only; the k-th score found there is shared with the searches of all other
shards in the second round.

Vectors are whole numbers, floor(64 * x). Scores are exact: double precision where every sum stays below 2^53, else Python's whole numbers,
held to the range of a long.

Defined cases: vectors that are NULL, empty or hold NULL or non-finite components take no part, nor do rows without id; vectors of different
lengths do not meet; a query skips rows with its own id; repeated equal query rows
are one query, different vectors under one id are one each (their rows follow each other under that id); repeated candidates count each; equal scores go to the smaller id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costledger.llm.common import by_groups, in_batches, stored, whole_groups
from costledger.llm.vectors import as_binary, as_matrix, usable

SCALE = 64
SHARD, QUERIES = 16384, 4096
LEAF = 256
EXACT = 2.0**53
LONG = 2**63 - 1
NO_ID = np.iinfo(np.int64).max


def whole_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id``, ``length`` and ``vector`` (packed doubles with whole numbers) of the vectors that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, vectors = usable(batch.column(1))
            with np.errstate(over="ignore"):
                scaled = [np.floor(scale * v) for v in vectors]
            fine = [i for i, v in enumerate(scaled) if np.isfinite(v).all()]
            ids = batch.column(0).take(pa.array(at[fine], pa.int64()))
            lengths = pa.array([len(scaled[i]) for i in fine], pa.int32())
            yield pa.RecordBatch.from_arrays([ids, lengths, as_binary([scaled[i] for i in fine])], ["vec_id", "length", "vector"])

    kept = embeddings.where("vec_id IS NOT NULL").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return in_batches(kept, run, "vec_id long, length int, vector binary", 2000)


class BallTree:
    """Balls over the rows of a matrix; a node covers a range of the reordered rows."""

    def __init__(self, points: np.ndarray, ids: np.ndarray):
        self.order = np.arange(len(points))
        self.nodes: list[tuple[int, int, int, int]] = []  # first row, last row, children (0: leaf)
        self.centers: list[np.ndarray] = []
        self.radii: list[float] = []
        self._build(points, 0, len(points))
        self.points, self.ids = points[self.order], ids[self.order]

    def _build(self, points: np.ndarray, first: int, last: int) -> int:
        own = points[self.order[first:last]]
        center = own.mean(axis=0)
        away = own - center
        distances = np.sqrt((away * away).sum(axis=1))
        node = len(self.nodes)
        self.nodes.append((first, last, 0, 0))
        self.centers.append(center)
        self.radii.append(float(distances.max()))
        if last - first > LEAF and distances.max() > 0:
            # along the line to the farthest point, half to either side
            along = away @ away[int(distances.argmax())]
            half = (last - first) // 2
            self.order[first:last] = self.order[first:last][np.argpartition(along, half)]
            left = self._build(points, first, first + half)
            right = self._build(points, first + half, last)
            self.nodes[node] = (first, last, left, right)
        return node


class Best:
    """The k best candidates of each query so far, and the score that a new one must reach."""

    def __init__(self, bounds: np.ndarray, k: int):
        self.k = k
        self.scores = np.full((len(bounds), k), -np.inf)
        self.ids = np.full((len(bounds), k), NO_ID)
        self.bounds = bounds.copy()

    def add(self, queries: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores``: queries by candidates; -inf for none."""
        last, last_id = self.scores[queries, -1], self.ids[queries, -1]
        better = (scores > last[:, None]) | ((scores == last[:, None]) & (ids < last_id[:, None]))
        better &= (scores >= self.bounds[queries][:, None]) & (scores > -np.inf)
        some = np.flatnonzero(better.any(axis=1))
        if not len(some):
            return
        rows = queries[some]
        new = np.where(better[some], scores[some], -np.inf)
        all_scores = np.concatenate((self.scores[rows], new), axis=1)
        all_ids = np.concatenate((self.ids[rows], np.where(better[some], ids, NO_ID)), axis=1)
        order = np.lexsort((all_ids, -all_scores), axis=1)[:, : self.k]
        self.scores[rows] = np.take_along_axis(all_scores, order, axis=1)
        self.ids[rows] = np.take_along_axis(all_ids, order, axis=1)
        self.bounds[rows] = np.maximum(self.bounds[rows], self.scores[rows, -1])


def search(tree: BallTree, queries: np.ndarray, query_ids: np.ndarray, bounds: np.ndarray, k: int) -> Best:
    """Branch and bound for all queries of a block; the node with the highest bound of any query is next."""
    best = Best(bounds, k)
    lengths = np.sqrt((queries * queries).sum(axis=1))

    def upper(node: int, active: np.ndarray) -> np.ndarray:
        center, radius = tree.centers[node], tree.radii[node]
        reach = lengths[active] * radius
        # the margin covers rounding
        return queries[active] @ center + reach + 1e-9 * (reach + lengths[active] * np.sqrt((center * center).sum())) + 1e-6

    everyone = np.arange(len(queries))
    first = upper(0, everyone)
    heap = [(-float(first.max()), 0, everyone, first)]
    while heap:
        _, node, active, above = heapq.heappop(heap)
        active = active[above >= best.bounds[active]]
        if not len(active):
            continue
        low, high, left, right = tree.nodes[node]
        if left:
            for child in (left, right):
                above = upper(child, active)
                still = above >= best.bounds[active]
                if still.any():
                    heapq.heappush(heap, (-float(above[still].max()), child, active[still], above[still]))
        else:
            scores = queries[active] @ tree.points[low:high].T
            scores[query_ids[active][:, None] == tree.ids[low:high]] = -np.inf
            best.add(active, scores, tree.ids[low:high])
    return best


def search_large(points: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """Place of the query, candidate, score where sums exceed double precision: whole numbers of any size, held to a long."""
    wide = [[int(x) for x in row] for row in points]
    found = []
    for place, (q, own) in enumerate(zip(queries, query_ids.tolist(), strict=True)):
        whole = [int(x) for x in q]
        scores = [(max(-LONG - 1, min(LONG, sum(a * b for a, b in zip(whole, row, strict=True)))), i) for row, i in zip(wide, ids.tolist(), strict=True) if i != own]
        found += [(place, i, s) for s, i in sorted(scores, key=lambda x: (-x[0], x[1]))[:k]]
    return found


def _searched(rows: DataFrame, k: int) -> DataFrame:
    """``query_id``, ``variant``, ``vec_id``, ``score``: the best of each shard and block. ``rows``: candidates (``bound`` NULL) and queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, starts in whole_groups(batches, 3):
            is_query, ids = part.column(3).to_numpy(), part.column(4).to_numpy()
            bounds, variants = part.column(6).to_numpy(), part.column(7).to_numpy()
            for s, e in zip(starts[:-1], starts[1:], strict=True):
                asked = is_query[s:e] == 1
                if asked.all() or not asked.any():
                    continue
                matrix = as_matrix(part.column(5).slice(s, e - s))
                points, queries = matrix[~asked], matrix[asked]
                point_ids, query_ids = ids[s:e][~asked], ids[s:e][asked]
                largest = np.abs(points).max() * np.abs(queries).max() * matrix.shape[1]
                if largest < EXACT:
                    best = search(BallTree(points, point_ids), queries, query_ids, bounds[s:e][asked], k)
                    row, column = np.nonzero(best.ids != NO_ID)
                    hits, scores = best.ids[row, column], best.scores[row, column].astype(np.int64)
                else:
                    large = list(zip(*search_large(points, point_ids, queries, query_ids, k), strict=True)) or [[], [], []]
                    row, hits, scores = np.array(large[0], dtype=np.int64), large[1], large[2]
                found = [query_ids[row], variants[s:e][asked][row], hits, scores]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], ["query_id", "variant", "vec_id", "score"])

    return by_groups(rows, ["length", "shard", "block"], run, "query_id long, variant long, vec_id long, score long")


def best_of(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id", "variant").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(embeddings: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` for the rows of ``queries`` (``vec_id``, ``embedding``) against all of ``embeddings``."""
    points = stored(whole_vectors(embeddings), "topk_points")
    # equal queries are one; different vectors under one id are told apart by a number
    distinct = whole_vectors(queries).withColumnRenamed("vec_id", "query_id").dropDuplicates(["query_id", "length", "vector"])
    variant = F.row_number().over(Window.partitionBy("query_id").orderBy("length", "vector")).cast("long")
    asked = stored(distinct.withColumn("variant", variant), "topk_queries")
    shards = max(1, -(-points.count() // SHARD))
    blocks = max(1, -(-asked.count() // QUERIES))
    columns = ["length", "shard", "block", "is_query", "id", "vector", "bound", "variant"]
    every = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    shard, block = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"), F.pmod(F.xxhash64("query_id", F.lit(1)), F.lit(blocks)).cast("int")
    no_bound = F.lit(float("-inf"))
    held = points.select("length", shard.alias("shard"), every(blocks, "block"), F.lit(0).alias("is_query"), F.col("vec_id").alias("id"), "vector", no_bound.alias("bound"), F.lit(0).cast("long").alias("variant"))
    home = F.pmod(F.xxhash64("query_id", F.lit(2)), F.lit(shards)).cast("int")
    first = asked.select("length", home.alias("shard"), block.alias("block"), F.lit(1).alias("is_query"), F.col("query_id").alias("id"), "vector", no_bound.alias("bound"), "variant")
    found = stored(_searched(held.select(columns).union(first.select(columns)), k), "topk_first")
    if shards > 1:
        kth = found.groupBy("query_id", "variant").agg(F.min("score").alias("kth"), F.count("*").alias("n")).where(F.col("n") >= k)
        rest = asked.join(kth, ["query_id", "variant"], "left").select("*", every(shards, "shard")).where(F.col("shard") != home)
        bound = F.coalesce(F.col("kth").cast("double"), no_bound).alias("bound")
        rest = rest.select("length", "shard", block.alias("block"), F.lit(1).alias("is_query"), F.col("query_id").alias("id"), "vector", bound, "variant")
        found = found.union(_searched(held.select(columns).union(rest.select(columns)), k))
    return best_of(found, k).select("query_id", "rank", "vec_id", "score")
