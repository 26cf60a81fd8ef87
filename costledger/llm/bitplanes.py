"""Centroid clustering of vectors of 64 components by bit planes and counts of common bits.

Components become whole numbers, ``floor(SCALE * x)``. Bit b of all 64 of them, in two's complement, is one unsigned 64-bit number, the
plane b. The dot product of two vectors is the sum over their planes of 2^(a + b) times the number of bits that plane a of the one and
plane b of the other have in common; the top plane, of the sign, counts negative. So a vector is kept as a handful of numbers (some 12
planes, 96 bytes, for components up to 1 instead of 512), and squared distances |x|^2 - 2 x.c + |c|^2 are exact.

``cluster`` runs Lloyd's rounds: each is one pass over the stored planes, in which a task hands on a count and sums for each centroid,
not its vectors. Sums travel in limbs of 40 bits, so they are exact too, whatever their size. The driver sees the centroids only
(``k`` x 64 whole numbers and their sums), of a number that is a parameter and does not grow with the rows.

Defined cases: vectors that are NULL, have another number of components or hold a NULL, NaN or infinite one are left out; equal distances go to the
smaller centroid; a centroid without vectors stays as it is; with fewer vectors than centroids there are fewer centroids; without vectors the result is empty;
repeated rows count each; rows without id take part, but come last in the choice of first centroids; equal ids are ordered there by their components. Components of
any finite size are taken: where 64-bit numbers would not hold a product, Python's numbers do, and a distance or inertia beyond 64 bits
is NULL. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costledger.llm.common import in_batches, stored
from costledger.llm.vectors import usable

WIDTH = 64
SCALE = 1024
ROWS = 4096
LIMB = 40
LONGEST = 2**63 - 1


def whole_numbers(vectors: list[np.ndarray], scale: int = SCALE) -> np.ndarray:
    """``floor(scale * x)`` exactly, as 64-bit numbers or, where these do not hold them, as Python's; ``scale`` is a power of two."""
    matrix = np.array(vectors, dtype=np.float64).reshape(len(vectors), -1)
    if np.abs(matrix).max(initial=0) < 2.0**52 / scale:
        return np.floor(matrix * scale).astype(np.int64)
    return np.array([[math.floor(math.ldexp(x, scale.bit_length() - 1)) if abs(x) < 2.0**900 else int(x) * scale for x in row] for row in matrix.tolist()], dtype=object)


def planes_needed(numbers: np.ndarray) -> int:
    """Bits of the largest number, and one for the sign."""
    return max((int(x).bit_length() for x in (numbers.min(initial=0) + 1, numbers.max(initial=0))), default=0) + 1


def planes_of(numbers: np.ndarray) -> np.ndarray:
    """Rows of 64 whole numbers as rows of planes, the lowest first."""
    out = np.empty((len(numbers), planes_needed(numbers)), dtype=np.uint64)
    for b in range(out.shape[1]):
        bits = ((numbers >> b) & 1).astype(bool)
        out[:, b] = np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def weights(planes: int) -> list[int]:
    """What a bit of each plane counts."""
    return [1 << b for b in range(planes - 1)] + [-(1 << (planes - 1))]


def weighted(planes: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """The planes of some rows with what their bits count; neighbours that are equal in all rows count as one, and zeros not at all."""
    found: list[tuple[int, np.ndarray]] = []
    for b, weight in enumerate(weights(planes.shape[1])):
        plane = planes[:, b]
        if found and np.array_equal(found[-1][1], plane):
            found[-1] = (found[-1][0] + weight, plane)
        else:
            found.append((weight, plane))
    return [(weight, plane) for weight, plane in found if plane.any()]


def number_type(bits: int) -> type:
    """Whether 64-bit numbers hold a sum of 64 products whose factors have so many bits together."""
    return np.int64 if bits + 8 < 63 else object


def dot_products(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact dot products of all rows of planes ``x`` with all rows of planes ``c``."""
    kind = number_type(x.shape[1] + c.shape[1])
    total = np.zeros((len(x), len(c)), dtype=kind)
    of_c = weighted(c)
    for weight, plane in weighted(x):
        for other, own in of_c:
            total += np.bitwise_count(plane[:, None] & own[None, :]).astype(kind) * (weight * other)
    return total


def squares(x: np.ndarray) -> np.ndarray:
    """Exact squared lengths of rows of planes."""
    kind = number_type(2 * x.shape[1])
    total = np.zeros(len(x), dtype=kind)
    planes = weighted(x)
    for a, (weight, plane) in enumerate(planes):
        for b, (other, own) in enumerate(planes[: a + 1]):
            total += np.bitwise_count(plane & own).astype(kind) * (weight * other * (1 if a == b else 2))
    return total


def numbers_of(planes: np.ndarray) -> np.ndarray:
    """The 64 whole numbers of each row of planes."""
    kind = number_type(planes.shape[1])
    out = np.zeros((len(planes), WIDTH), dtype=kind)
    for b, weight in enumerate(weights(planes.shape[1])):
        bits = np.unpackbits(np.ascontiguousarray(planes[:, b]).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        out += bits.astype(kind) * weight
    return out


def read_planes(column: pa.Array) -> np.ndarray:
    """Stored planes as a matrix; rows with fewer planes repeat that of the sign."""
    rows = column.to_pylist()
    sizes = np.array([len(r) // 8 for r in rows], dtype=np.int64)
    flat = np.frombuffer(b"".join(rows), dtype="<u8").astype(np.uint64)
    at = np.minimum(np.arange(int(sizes.max(initial=1)))[None, :], sizes[:, None] - 1)
    return flat[at + (np.cumsum(sizes) - sizes)[:, None]]


class Nearest:
    """The nearest of some centroids."""

    def __init__(self, centroids: list[list[int]]):
        self.numbers = np.array(centroids, dtype=object).reshape(-1, WIDTH)
        self.planes = planes_of(self.numbers)
        self.squares = squares(self.planes)

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the centroid and squared distance of each row of planes."""
        dots, own, other = dot_products(x, self.planes), squares(x), self.squares
        if object in (dots.dtype, own.dtype, other.dtype):
            dots, own, other = dots.astype(object), own.astype(object), other.astype(object)
        distances = own[:, None] - 2 * dots + other[None, :]
        best = distances.argmin(axis=1)
        return best, distances[np.arange(len(x)), best]


def pack(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``planes`` (little-endian 64-bit numbers) of the vectors that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, values = usable(batch.column(1))
            fits = [k for k, v in enumerate(values) if len(v) == WIDTH]
            if fits:
                planes = planes_of(whole_numbers([values[k] for k in fits], scale)).astype("<u8")
                packed = pa.array([row.tobytes() for row in planes], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at[fits])), packed], ["vec_id", "planes"])

    return in_batches(vectors.select("vec_id", "embedding"), run, f"vec_id {dict(vectors.dtypes)['vec_id']}, planes binary", ROWS)


def first_centroids(packed: DataFrame, k: int, seed: str) -> list[list[int]]:
    """The vectors whose ids have the smallest hashes."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = packed.orderBy(digest.asc_nulls_last(), "planes").limit(k).select("planes").collect()
    return [numbers_of(read_planes(pa.array([bytes(r["planes"])], pa.binary())))[0].tolist() for r in rows]


def limbs(value: int) -> Iterator[tuple[int, int]]:
    """A whole number as digits of 40 bits, each with the number's sign."""
    sign, rest, place = (-1 if value < 0 else 1), abs(value), 0
    while rest:
        yield place, sign * (rest & ((1 << LIMB) - 1))
        rest >>= LIMB
        place += 1


def cluster_sums(packed: DataFrame, centroids: list[list[int]]) -> dict[int, tuple[int, list[int]]]:
    """Number of vectors and sums of components of each centroid that has vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = Nearest(centroids)
        counts = [0] * len(centroids)
        totals = [[0] * WIDTH for _ in centroids]
        for batch in batches:
            if not batch.num_rows:
                continue
            planes = read_planes(batch.column(0))
            best, numbers = nearest(planes)[0], numbers_of(planes)
            for c in np.unique(best).tolist():
                chosen = numbers[best == c]
                counts[c] += len(chosen)
                totals[c] = [a + int(b) for a, b in zip(totals[c], chosen.sum(axis=0).tolist(), strict=True)]
        rows = [(c, -1, 0, counts[c]) for c in range(len(centroids)) if counts[c]]
        rows += [(c, j, place, digit) for c in range(len(centroids)) for j in range(WIDTH) for place, digit in limbs(totals[c][j])]
        columns = [pa.array([r[i] for r in rows], pa.int32() if i < 3 else pa.int64()) for i in range(4)]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "component", "place", "digit"])

    parts = in_batches(packed.select("planes"), run, "cluster int, component int, place int, digit long", ROWS)
    # at most k * (1 + 64 * 28) rows: a double has no more limbs
    summed = parts.groupBy("cluster", "component", "place").agg(F.sum(F.col("digit").cast("decimal(38,0)")).alias("digit")).collect()
    found: dict[int, tuple[int, list[int]]] = {r["cluster"]: (int(r["digit"]), [0] * WIDTH) for r in summed if r["component"] < 0}
    for r in summed:
        if r["component"] >= 0:
            found[r["cluster"]][1][r["component"]] += int(r["digit"]) << (LIMB * r["place"])
    return found


def learn_centroids(packed: DataFrame, k: int, rounds: int, seed: str) -> list[list[int]]:
    """Lloyd's rounds over stored planes."""
    centroids = first_centroids(packed, k, seed)
    for _ in range(rounds if centroids else 0):
        moved = {c: [total // n for total in sums] for c, (n, sums) in cluster_sums(packed, centroids).items()}
        if all(centroids[c] == numbers for c, numbers in moved.items()):
            break  # a further round would change nothing
        centroids = [moved.get(c, numbers) for c, numbers in enumerate(centroids)]
    return centroids


def assign(packed: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``vec_id``, ``cluster`` and ``distance`` (squared) of each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = Nearest(centroids)
        for batch in batches:
            if batch.num_rows:
                best, distances = nearest(read_planes(batch.column(1)))
                held = [d if d <= LONGEST else None for d in distances.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(best.astype(np.int32)), pa.array(held, pa.int64())], ["vec_id", "cluster", "distance"]
                )

    return in_batches(packed, run, f"vec_id {dict(packed.dtypes)['vec_id']}, cluster int, distance long", ROWS)


def centroid_digest(numbers: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: str = "3", scale: int = SCALE) -> tuple[DataFrame, list[list[int]]]:
    """``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` of each vector; and the centroids."""
    packed = stored(pack(vectors, scale), "planes")
    centroids = learn_centroids(packed, k, rounds, seed)
    assigned = stored(assign(packed, centroids), "assigned")
    total = F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")
    unknown = F.count_if(F.col("distance").isNull()).alias("unknown")
    sums = {r["cluster"]: None if r["unknown"] else int(r["total"]) for r in assigned.groupBy("cluster").agg(total, unknown).collect()}  # a row a centroid
    inertia = None if None in sums.values() else sum(sums.values())
    known = [(c, sums.get(c), inertia, centroid_digest(numbers)) for c, numbers in enumerate(centroids)]
    kept = [tuple(None if isinstance(v, int) and v > LONGEST else v for v in row) for row in known]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    about = vectors.sparkSession.createDataFrame(kept, schema)
    # a row a centroid
    return assigned.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"), centroids
