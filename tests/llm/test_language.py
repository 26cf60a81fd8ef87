from collections import Counter

import pytest

from costledger.llm import language, queries
from costledger.llm.common import crc_remainder

DOCS = "doc_id long, text string, lang string, gram int, n string, rank int"


def plain_grams(text):
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    found = Counter()
    for word in words:
        found.update(word)
    line = " " + " ".join(words) + " " if words else ""
    for n in (2, 3):
        found.update(line[i : i + n] for i in range(len(line) - n + 1) if n == 2 or line[i + 1] != " ")
    return found


def plain_list(counts, most):
    number = lambda g: sum(ord(c) << (21 * (len(g) - 1 - i)) for i, c in enumerate(g))
    return sorted(counts, key=lambda g: (-counts[g], number(g)))[:most]


def plain_predict(text, profiles, most):
    own = plain_list(plain_grams(text), most)
    if not own or not profiles:
        return "und"
    distance = lambda p: sum(abs(p.index(g) - i) if g in p else most for i, g in enumerate(own))
    return min(sorted(profiles), key=lambda lang: (distance(profiles[lang]), lang.encode()))


def test_equals_a_plain_version(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("held_out", crc_remainder("doc_id", 4) == 2)
    rows = docs.collect()
    counts = {}
    for r in rows:
        if not r["held_out"] and r["lang"] is not None:
            counts.setdefault(r["lang"], Counter()).update(plain_grams(r["text"]))
    profiles = {lang: plain_list(c, language.PROFILE) for lang, c in counts.items()}
    got = {r["doc_id"]: r for r in queries.op2_language(spark, sf).collect()}
    assert set(got) == {r["doc_id"] for r in rows}
    for r in rows[:80]:
        assert got[r["doc_id"]]["lang_pred"] == plain_predict(r["text"], profiles, language.PROFILE)
        assert got[r["doc_id"]]["held_out"] == r["held_out"] and 0 <= got[r["doc_id"]]["score"] <= 1
    held = [r for r in rows if r["held_out"] and r["lang"] is not None]
    assert sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held) >= 0.95 * len(held)


def test_odd_rows(spark):
    rows = [
        (1, "der und die das nicht ein eine " * 5, "de", 1, "x", 2), (2, "the and of to in that " * 5, "en", 1, "x", 2),
        (2, "the and of to in that " * 5, "en", 1, "x", 2), (3, None, "en", 1, "x", 2), (4, "", None, 1, "x", 2), (5, "123 !?", "de", 1, "x", 2),
        (None, "the and of", None, None, None, None), (6, "x" * 300_000, None, 1, "x", 2), (7, "\u0130\U0001d400 \ud7a3", None, 1, "x", 2),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    found = language.identify(docs, language.learn_profiles(docs)).collect()
    got = {r["doc_id"]: r["lang_pred"] for r in found}
    assert len(found) == len(rows)
    assert got[1] == "de" and got[2] == "en" and got[None] == "en"
    assert {got[3], got[4], got[5]} == {"und"} and got[6] in ("de", "en") and got[7] in ("de", "en")


def test_nothing_learned(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    profiles = language.learn_profiles(docs)
    assert profiles == {} and language.identify(docs, profiles).first()["lang_pred"] == "und"


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    assert language.identify(docs, language.learn_profiles(docs)).count() == 0


def test_counts_are_handed_on_when_many_are_held(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(50)
    whole = {(r["lang"], r["gram"]): r["n"] for r in language.gram_counts(docs).collect()}
    assert sum(whole.values()) == sum(sum(plain_grams(r["text"]).values()) for r in docs.collect() if r["lang"])


@pytest.mark.parametrize("text", ["a", "ab", "Aa bb\u00e9  c3c", "'", "x y"])
def test_grams(text):
    number = lambda g: sum(ord(c) << (21 * (len(g) - 1 - i)) for i, c in enumerate(g))
    assert Counter(language.grams(text).tolist()) == Counter({number(g): n for g, n in plain_grams(text).items()})
