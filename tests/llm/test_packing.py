import random
import zlib
from collections import defaultdict
from functools import cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from costledger.llm import packing, queries

PATH = queries.tokenizer_path()
DOCS = "doc_id long, text string, ids string, level int"


@cache
def plain_tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def whole_ids(text):
    tokenizer = plain_tokenizer()
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, texts):
    """Every id of every document lies in one piece; sequences are gapless and no longer than a window."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(pieces) == set(texts)
    for doc, text in texts.items():
        ids, at = whole_ids(text), 0
        for r in sorted(pieces[doc], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert np.frombuffer(r["ids"], "<u4").tolist() == ids[at : at + r["length"]]
            at += r["length"]
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= packing.WINDOW
    return sequences


def test_pieces_give_back_the_ids_of_the_tokenizer(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = packing.pack(docs.coalesce(1), PATH).collect()
    sequences = check(rows, texts)
    partly = [sum(r["length"] for r in s) for s in sequences.values() if sum(r["length"] for r in s) < packing.WINDOW]
    assert len(partly) <= 1


def test_odd_texts_and_clashing_columns(spark):
    texts = {
        1: None, 2: "", 3: "   \n\t ", 4: "Straße\u00a0don't  I'LL 42 ÀÉ x\u2028y", 5: "<|endoftext|> a", 6: "\x1c\x1fcontrol\x00chars", 7: "word " * 9000,
        11: "<|ENDOFTEXT|> b <|startoftext|>", 12: "x<|endoftext|>y  z", 13: "<|end oftext|>", 14: "don't 've'RE 12,5% <b>&amp;</b>",
        8: "e\u0301te\u0301 \u03a3\u03a3 漢字かな", 9: "same", 10: "same", None: "no id",
    }
    docs = spark.createDataFrame([(i, t, "x", 7) for i, t in texts.items()], DOCS)
    check(packing.pack(docs, PATH).collect(), texts)


@pytest.mark.parametrize("cached", [1, 30, 400_000])
def test_forgotten_words_are_learned_again(monkeypatch, cached):
    monkeypatch.setattr(packing, "CACHED_WORDS", cached)
    ids_of, draw = packing.TextIds(PATH), random.Random(cached)
    for _ in range(150):
        text = " ".join(f"{draw.choice('abcÄß')}{draw.choice('defgh漢字')}{draw.randrange(40)}." for _ in range(draw.randrange(30)))
        assert np.frombuffer(ids_of(text), "<u4").tolist() == whole_ids(text)[:-1]
        assert max(len(ids_of.words), len(ids_of.pieces)) <= cached + 150


def test_plain_words_get_the_ids_of_the_tokenizer():
    every = [chr(c) for c in range(0x21, 0x180) if packing.PLAIN.fullmatch(chr(c)) and chr(c) != " "] + list("¡¿«»“”„‘’…–—")
    draw = random.Random(1)
    texts = ["".join(draw.choice(every) for _ in range(draw.randint(1, 12))) for _ in range(4000)] + every + [a + "'" + b for a in "é'x" for b in every]
    assert len(every) > 200 and all(packing.PLAIN.fullmatch(t) for t in texts)
    ids_of = packing.TextIds(PATH)
    assert [np.frombuffer(ids_of(t), "<u4").tolist() for t in texts] == [whole_ids(t)[:-1] for t in texts]


def test_repeated_rows_are_packed_each(spark):
    docs = spark.createDataFrame([(1, "one two", "x", 7)] * 3, DOCS).coalesce(1)
    rows = packing.pack(docs, PATH).collect()
    assert [(r["doc_id"], r["start"]) for r in rows] == [(1, 0)] * 3 and len({(r["sequence_id"], r["offset"]) for r in rows}) == 3


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], DOCS), PATH).count() == 0


def test_query_has_the_crc_of_each_piece(spark):
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["ids_crc32"] for r in queries.packed_pieces(docs).collect()}
    assert got == {i: zlib.crc32(np.array(whole_ids(t), "<u4").tobytes()) for i, t in ((1, "some words"), (2, None))}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 63), max_size=150), st.integers(1, 40))
def test_levels_choose_the_smallest_sum_of_squares(sizes, most_open):
    window = 64
    levels, closed = packing.SquaredLevels(window), []
    for n, size in enumerate(sizes):
        counts = levels.counts.copy()

        def after(level, counts=counts, size=size):
            new = counts.copy()
            new[level] -= level > 0
            if level + size < window:
                new[level + size] += 1
            return int((new**2).sum())

        allowed = [0, *(h for h in range(1, window - size + 1) if counts[h])]
        full = levels.place((n, 0, b"\0" * 4 * size, size), size)
        closed += [full] if full else []
        assert int((levels.counts**2).sum()) == min(after(h) for h in allowed)
        if levels.n_open >= most_open:
            closed += levels.drain(most_open // 2)
            assert levels.n_open <= most_open // 2 and (levels.counts.sum(), [len(p) for p in levels.open]) == (levels.n_open, list(levels.counts[:-1]))
    closed += levels.drain()
    fills = [sum(len(p[2]) // 4 for p in pieces) for pieces in closed]
    assert sum(fills) == sum(sizes) and max(fills, default=0) <= window and levels.n_open == 0


@pytest.mark.parametrize("open_windows", [[], [5], [1, 2, 3], [60, 60, 9], [63] * 5])
def test_drain_leaves_one_window_partly_filled(open_windows):
    levels = packing.SquaredLevels(64)
    for n, size in enumerate(open_windows):
        levels.open[size].append([(n, 0, bytes(4 * size), size)])
        levels.n_open += 1
    fills = [sum(len(p[2]) // 4 for p in pieces) for pieces in levels.drain()]
    assert sum(fills) == sum(open_windows) and sum(f < 64 for f in fills) <= 1
