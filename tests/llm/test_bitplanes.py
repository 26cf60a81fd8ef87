import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest

from costledger.llm import bitplanes

VECTORS = "vec_id long, embedding array<double>, cluster int, distance string, planes int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 9, "x", 8) for i, v in rows], VECTORS)


def whole(x):
    numerator, denominator = float(x).as_integer_ratio()
    return 1024 * numerator // denominator


def plain(rows, k=8, rounds=10):
    """Lloyd's rounds in Python's whole numbers."""
    kept = [(i, [whole(x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest()))
    centroids = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for n, members in groups.items():
            centroids[n] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    found = [(i, *nearest(v)) for i, v in kept]
    sums = {}
    for _, d, n in found:
        sums[n] = sums.get(n, 0) + d
    short = lambda x: x if x < 2**63 else None
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    known = all(short(d) is not None for _, d, _ in found)
    total = sum(sums.values())
    whole_of = {n: short(s) if all(short(d) is not None for _, d, m in found if m == n) else None for n, s in sums.items()}
    return sorted(((i, n, short(d), whole_of[n], short(total) if known else None, digest[n]) for i, d, n in found), key=str)


def clustered(spark, rows, **options):
    found = bitplanes.cluster(frame(spark, rows), **options)[0].collect()
    return sorted(((r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in found), key=str)


def draws(seed, n, spread=1.0):
    draw = np.random.default_rng(seed)
    centers = draw.normal(size=(5, 64))
    return [(int(i), [float(x) for x in centers[draw.integers(0, 5)] + draw.normal(size=64) * spread]) for i in draw.permutation(10 * n)[:n]]


@pytest.mark.parametrize("bits", [1, 5, 12, 27, 40, 300])
def test_products_of_planes_are_exact(bits):
    draw = random.Random(bits)
    x = [[draw.randint(-(1 << bits), 1 << bits) for _ in range(64)] for _ in range(7)] + [[0] * 64, [-(1 << bits)] * 64]
    kind = np.int64 if bits < 60 else object
    planes = bitplanes.planes_of(np.array(x, dtype=kind))
    assert bitplanes.numbers_of(planes).tolist() == x
    assert bitplanes.dot_products(planes, planes).tolist() == [[sum(p * q for p, q in zip(a, b, strict=True)) for b in x] for a in x]
    assert bitplanes.squares(planes).tolist() == [sum(p * p for p in a) for a in x]
    stored = pa.array([row.astype("<u8").tobytes() for row in planes[:3]] + [planes[3, :1].astype("<u8").tobytes()], pa.binary())
    assert bitplanes.read_planes(stored).shape == planes[:4].shape


@pytest.mark.parametrize("value", [0, 1, -1, 2**40, -(2**40) - 5, 3**200, -(3**200)])
def test_limbs_add_up(value):
    assert sum(digit << (bitplanes.LIMB * place) for place, digit in bitplanes.limbs(value)) == value


def test_equal_to_a_plain_version(spark):
    rows = draws(1, 300)
    assert clustered(spark, rows) == plain(rows)
    assert clustered(spark, rows, k=3, rounds=2) == plain(rows, 3, 2)


def test_odd_rows(spark):
    rows = draws(2, 40, 0.1)
    rows += [(rows[0][0], rows[0][1])] * 30 + [(None, rows[1][1]), (None, rows[1][1])]  # repeated rows, rows without id
    rows += [(-1, None), (-2, []), (-3, [1.0] * 63), (-4, [1.0] * 65), (-5, [None] + [1.0] * 63), (-6, [math.nan] * 64), (-7, [math.inf] * 64)]
    rows += [(-8, [0.0] * 64), (-9, [-1e-9] * 64)]
    assert clustered(spark, rows) == plain(rows)


def test_equal_vectors_go_to_the_first_centroid(spark):
    rows = [(i, [0.5] * 64) for i in range(20)]
    assert {r[1] for r in clustered(spark, rows)} == {0} and clustered(spark, rows) == plain(rows)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = draws(3, 3)
    assert clustered(spark, rows) == plain(rows)
    assert clustered(spark, []) == [] and clustered(spark, [(1, None), (2, [1.0])]) == []


def test_components_of_any_size(spark):
    rows = draws(4, 30) + [(-1, [1e9] * 64), (-2, [-3e12] * 32 + [1.5] * 32), (-3, [1e300] * 64), (-4, [-1.7e308] + [0.25] * 63)]
    assert clustered(spark, rows, rounds=3) == plain(rows, rounds=3)
