"""Near-duplicate vectors by collision-counting projections.

Every vector, scaled to length one, is projected on many random lines. The projections of two vectors with a cosine of ``LEAST_COSINE`` differ by a
normal deviate with the standard deviation ``sqrt(2 - 2 * LEAST_COSINE)`` at most, and lie within a window centred on either of them with a known
probability, so the number of collisions over ``COUNTED`` lines is binomial. A pair is verified in double precision if it has as many
collisions as such a pair misses with probability ``LOST`` only.

A single line separates little, so counting collisions over all rows would grow with their square. Rows are therefore sorted by ``depth`` coarse
projections first (cells of width ``CELL`` with random offsets), in ``tables`` independent ways, and collisions are counted within cells. Depth
grows with the logarithm of the rows, so a vector meets a bounded number of strangers; the number of tables follows from ``RECALL`` at the threshold.

A pair belongs to the first table in which it shares a cell. Tasks hand on a sum of links for each vector and a spanning forest, never pairs; cells
of more than ``BLOCK`` rows are compared in pairs of blocks. Equal vectors are one class with a weight.

Defined cases: vectors that are NULL, empty, zero or hold NULL or non-finite components link with nothing; vectors of different lengths do not
link; a NULL id has NULL component; repeated rows are copies; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costledger.llm.common import block_pairs, by_groups, in_batches, mix, stored, whole_groups
from costledger.llm.graph import Forest, components
from costledger.llm.vectors import as_binary, as_matrix, usable

LEAST_COSINE = 0.95
RECALL = 0.995
COUNTED = 24
LOST = 0.001
CELL = 1.0
#: Unrelated vectors that a vector meets in a cell, about.
STRANGERS = 300
BLOCK = 2048
SEED = 20
#: Rows compared at once, and pairs verified at once.
CHUNK, PAIRS = 256, 65536


def normal_within(x: float) -> float:
    return math.erf(x / math.sqrt(2))


class Plan:
    """Numbers of lines, tables and collisions for ``n`` vectors."""

    def __init__(self, n: int, least: float = LEAST_COSINE):
        self.least = least
        deviation = math.sqrt(2 - 2 * least)
        # chance that two values share a cell of random offset, for a difference with the given deviation
        share = lambda s: math.erf(CELL / s / math.sqrt(2)) - s / CELL * math.sqrt(2 / math.pi) * (1 - math.exp(-((CELL / s) ** 2) / 2))
        near, far = share(deviation), share(math.sqrt(2))
        self.depth = max(1, math.ceil(math.log(max(2.0, n / STRANGERS)) / -math.log(far)))
        self.tables = max(1, math.ceil(math.log(1 - RECALL) / math.log(1 - near**self.depth)))
        self.window = 2 * deviation
        hit = normal_within(2)
        lost, self.collisions = 0.0, 0
        for c in range(COUNTED + 1):
            lost += math.comb(COUNTED, c) * hit**c * (1 - hit) ** (COUNTED - c)
            if lost > LOST:
                break
            self.collisions = c + 1

    def lines(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lines of the cells, their offsets, lines of the counting; fixed for each length of vectors."""
        draw = np.random.default_rng([SEED, length])
        cells = draw.standard_normal((length, self.tables * self.depth))
        return cells, draw.random(self.tables * self.depth) * CELL, draw.standard_normal((length, COUNTED))


def unit(matrix: np.ndarray) -> np.ndarray:
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)  # squares of large numbers stay finite
    return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))


def packed_vectors(embeddings: DataFrame) -> DataFrame:
    """``vec_id``, ``vector`` (packed doubles; NULL if it takes no part) and its ``digest``."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [None] * batch.num_rows
            for i, v in zip(*usable(batch.column(1)), strict=True):
                if v.any():
                    packed[i] = (v + 0.0).astype("<f8").tobytes()  # + 0.0: a negative zero is zero
            digests = [xxhash.xxh3_128_digest(p) if p else None for p in packed]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary()), pa.array(digests, pa.binary())], ["vec_id", "vector", "digest"])

    schema = f"vec_id {dict(embeddings.dtypes)['vec_id']}, vector binary, digest binary"
    return in_batches(embeddings.select("vec_id", "embedding"), run, schema, 2000)


def with_cells(reps: DataFrame, plan: Plan) -> DataFrame:
    """Adds ``cells``: the number of the cell in each table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(2).to_pylist()
            cells = np.zeros((len(rows), plan.tables), dtype=np.int64)
            sizes = np.array([len(r) for r in rows], dtype=np.int64)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                vectors = unit(np.frombuffer(b"".join([rows[i] for i in at]), dtype="<f8").reshape(len(at), -1))
                lines, offsets, _ = plan.lines(vectors.shape[1])
                places = np.floor((vectors @ lines + offsets) / CELL).astype(np.int64).reshape(len(at), plan.tables, plan.depth)
                code = np.full((len(at), plan.tables), size, dtype=np.uint64)
                for k in range(plan.depth):
                    code = mix(code * np.uint64(31) + places[:, :, k].astype(np.uint64))
                cells[at] = code.view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * plan.tables), pa.array(cells.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], lists], ["rep", "weight", "vector", "cells"])

    return in_batches(reps.select("rep", "weight", "vector"), run, "rep long, weight long, vector binary, cells array<long>", 2000)


def near_pairs(vectors: np.ndarray, left: np.ndarray, right: np.ndarray, plan: Plan) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (of a row of ``left`` and a row of ``right``) with enough collisions and the cosine."""
    counting = plan.lines(vectors.shape[1])[2]
    values = vectors @ counting
    for low in range(0, len(left), CHUNK):
        rows = left[low : low + CHUNK]
        hits = np.zeros((len(rows), len(right)), dtype=np.uint8)
        for k in range(COUNTED):
            hits += np.abs(values[rows, k][:, None] - values[right, k]) <= plan.window
        a, b = np.nonzero(hits >= plan.collisions)
        for at in range(0, len(a), PAIRS):
            x, y = rows[a[at : at + PAIRS]], right[b[at : at + PAIRS]]
            near = np.einsum("ij,ij->i", vectors[x], vectors[y]) >= plan.least
            yield x[near], y[near]


def links_in_cell(table: int, ids: np.ndarray, weights: np.ndarray, blocks: np.ndarray, cells: np.ndarray, vectors: np.ndarray, plan: Plan, pair: tuple[int, int]) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Weight of the links of each row, and a spanning forest."""
    vectors = unit(vectors)
    linked, forest, edges = np.zeros(len(ids), dtype=np.int64), Forest(len(ids)), []
    left, right = np.flatnonzero(blocks == pair[0]), np.flatnonzero(blocks == pair[1])
    for x, y in near_pairs(vectors, left, right, plan):
        mine = ids[x] < ids[y] if pair[0] == pair[1] else np.ones(len(x), dtype=bool)
        mine &= ~(cells[x, :table] == cells[y, :table]).any(axis=1)  # else an earlier table has the pair
        x, y = x[mine], y[mine]
        np.add.at(linked, x, weights[y])
        np.add.at(linked, y, weights[x])
        edges += forest.spanning(x, y)
    return linked, edges


def link_rows(reps: DataFrame, plan: Plan) -> DataFrame:
    """Rows of either kind: ``a``, ``n`` (weight of links found) or ``a``, ``b`` (an edge of a spanning forest)."""
    placed = reps.select("rep", "weight", "vector", "cells", F.posexplode("cells").alias("table", "cell"))
    sizes = placed.groupBy("table", "cell").agg(F.count("*").alias("rows")).where("rows > 1")
    n_blocks = F.ceil(F.col("rows") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("rep"), n_blocks).cast("int")
    rows = placed.join(sizes, ["table", "cell"]).withColumn("block", block).withColumn("pair", F.explode(block_pairs(F.col("block"), n_blocks)))
    rows = rows.select("table", "cell", "pair.i", "pair.j", "block", "rep", "weight", "cells", "vector")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, starts in whole_groups(batches, 4):
            table, i, j, blocks, ids, weights = (part.column(k).to_numpy() for k in (0, 2, 3, 4, 5, 6))
            cells = part.column(7).combine_chunks().flatten().to_numpy().reshape(part.num_rows, plan.tables)
            a, b, n = [], [], []
            for s, e in zip(starts[:-1], starts[1:], strict=True):
                vectors = as_matrix(part.column(8).slice(s, e - s))
                pair = (int(i[s]), int(j[s]))
                linked, edges = links_in_cell(int(table[s]), ids[s:e], weights[s:e], blocks[s:e], cells[s:e], vectors, plan, pair)
                found = np.flatnonzero(linked)
                a += [*ids[s + found].tolist(), *(int(ids[s + x]) for x, _ in edges)]
                b += [*[None] * len(found), *(int(ids[s + y]) for _, y in edges)]
                n += [*linked[found].tolist(), *[None] * len(edges)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (a, b, n)], ["a", "b", "n"])

    return by_groups(rows, ["table", "cell", "i", "j"], run, "a long, b long, n long")


def near_vectors(embeddings: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """Per vector ``vec_id``, ``n_links``, ``component_id``, ``kept``."""
    packed = stored(packed_vectors(embeddings), "vectors")
    classes = packed.where("digest IS NOT NULL AND vec_id IS NOT NULL").groupBy("digest").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"))
    known = stored(packed.join(classes, "digest", "left"), "vector_classes")
    reps = known.where("vec_id = rep").select("rep", "weight", "vector").dropDuplicates(["rep"])
    plan = Plan(reps.count(), least)
    found = stored(link_rows(stored(with_cells(reps, plan), "vector_cells"), plan), "vector_links")
    links = found.where("n IS NOT NULL").groupBy("a").agg(F.sum("n").alias("links"))
    groups = components(found.where("b IS NOT NULL"), "vector_groups")
    joined = known.select("vec_id", "rep", "weight").join(links, F.col("rep") == F.col("a"), "left").join(groups, F.col("rep") == F.col("node"), "left")
    n_links = F.when(F.col("vec_id").isNotNull(), F.coalesce(F.col("weight") - 1, F.lit(0)) + F.coalesce("links", F.lit(0))).otherwise(F.lit(0))
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "rep", "vec_id"))
    kept = F.coalesce(component == F.col("vec_id"), F.lit(True))
    return joined.select("vec_id", n_links.alias("n_links"), component.alias("component_id"), kept.alias("kept"))
