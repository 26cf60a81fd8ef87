import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from costledger.llm import periodic, queries

DOCS = "doc_id long, text string, runs string, collapsed int, n_words string"


def plain_runs(words):
    """Every period against the whole text."""
    known, found = {}, {}
    ids = np.array([known.setdefault(w, len(known)) for w in words])
    for period in range(1, len(words) // 4 + 1):
        equal = np.concatenate(([0], (ids[:-period] == ids[period:]).astype(int), [0]))
        edges = np.diff(equal)
        for start, end in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist(), strict=True):
            length = end - start + period
            if length >= max(6, 4 * period):
                found.setdefault((start, length), period)
    return sorted((start, length, period) for (start, length), period in found.items())


def plain_collapsed(words):
    dropped = {i for start, length, period in plain_runs(words) for i in range(start + period, start + length)}
    return [w for i, w in enumerate(words) if i not in dropped]


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def split(text):
    return (text or "").encode().split()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c", b"\xc3\xa9"]), max_size=60), max_size=5))
def test_short_texts_equal_a_plain_version(texts):
    found = list(periodic.runs_of_texts(texts))
    assert [runs for runs, _ in found] == [plain_runs(t) for t in texts]
    assert [kept for _, kept in found] == [plain_collapsed(t) for t in texts]


@pytest.mark.parametrize("candidates", [3, 100_000])
def test_repeated_stretches_equal_a_plain_version(monkeypatch, candidates):
    monkeypatch.setattr(periodic, "CANDIDATES", candidates)
    draw = random.Random(candidates)
    for _ in range(150):
        texts = []
        for _ in range(draw.randint(1, 5)):
            t = [b"%d" % draw.randrange(draw.choice([2, 5, 200])) for _ in range(draw.choice([5, 6, 40, 300]))]
            for _ in range(draw.randint(0, 2)):
                a, p = draw.randrange(len(t)), draw.randint(1, 40)
                e = min(len(t), a + p * draw.randint(3, 9) + draw.randint(0, p))
                t = [t[a + (i - a) % p] if a <= i < e else t[i] for i in range(len(t))]
            texts.append(t)
        assert [r for r, _ in periodic.runs_of_texts(texts)] == [plain_runs(t) for t in texts]


def test_common_extensions_equal_a_plain_version():
    draw = random.Random(3)
    for size in (1, 2, 12, 13, 14, 27, 200):
        words = np.array([draw.randint(1, 2) for _ in range(size)] + [3])
        extensions = periodic.Extensions(words)
        pairs = [(i, j) for i in range(size + 1) for j in range(size + 1) if i != j][:3000]
        want = [next((k for k in range(size + 1) if max(i, j) + k > size or words[i + k] != words[j + k]), size) for i, j in pairs]
        i, j = np.array(pairs).T
        assert extensions.common(i, j).tolist() == want


def test_the_cover_reaches_samples_from_every_pair():
    for r in range(periodic.MODULUS):
        for s in range(periodic.MODULUS):
            d = periodic.TO_SAMPLES[r, s]
            assert {(r + d) % periodic.MODULUS, (s + d) % periodic.MODULUS} <= set(periodic.COVER)


@pytest.mark.parametrize("block", [100, 120_000])
def test_query_equals_a_plain_version_on_the_whole_table(spark, sf, monkeypatch, block):
    monkeypatch.setattr(periodic, "BLOCK_WORDS", block)
    digest = lambda x: hashlib.sha256(x).hexdigest()
    want = {}
    for row in spark.read.parquet(f"{sf}/documents.parquet").collect():
        words = planted(row["doc_id"], split(row["text"]))
        runs = plain_runs(words)
        start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        exponent = 1000 * length // period if runs else None
        want[row["doc_id"]] = (len(runs), start, length, period, exponent, digest(lines.encode()), digest(b" ".join(plain_collapsed(words))))
    columns = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {r["doc_id"]: tuple(r[c] for c in columns) for r in queries.op13_periodic(spark, sf).collect()} == want
    assert sum(bool(w[0]) for w in want.values()) > 10


def test_odd_rows_and_extra_columns(spark):
    rows = [(1, None), (1, None), (2, ""), (3, " \n\t"), (None, "a a a a a a"), (5, "x " * 5), (6, "b c " * 4), (6, "b c " * 4), (7, "           ")]
    docs = spark.createDataFrame([(i, t, "r", 1, "n") for i, t in rows], DOCS)
    found = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic.collapse_runs(docs).collect()]
    want = [(i, len(split(t)), plain_runs(split(t)), b" ".join(plain_collapsed(split(t))).decode()) for i, t in rows]
    assert sorted(found, key=str) == sorted(want, key=str)
    assert periodic.collapse_runs(spark.createDataFrame([], DOCS)).count() == 0


def test_a_very_long_text(spark):
    words = [f"w{i % 977}" for i in range(40_000)] + ["z"] * 40_000 + [f"v{i}" for i in range(20_000)]
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    row = periodic.collapse_runs(docs).first()
    assert [tuple(r) for r in row["runs"]] == [(0, 40_000, 977), (40_000, 40_000, 1)]
    assert len(row["collapsed"].split(" ")) == 977 + 1 + 20_000
