import random

import numpy as np
import pytest

from costledger.llm import queries, toxicity

DOCS = "doc_id long, text string, score double, toxic int, fold int, label int"
LABELS = "doc_id long, toxic int, quality int, text string"
FILLER = [f"{a}{b}" for a in ("lor", "mip", "tas", "neb", "quo", "vin", "dar") for b in ("ado", "ite", "ums", "ent", "oru", "ika")]


def made(seed, n, stem="grawl"):
    draw, rows = random.Random(seed), []
    for i in range(n):
        words = [draw.choice(FILLER) for _ in range(draw.randint(20, 80))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                words.insert(draw.randint(0, len(words)), draw.choice(["idiot", "moron", stem + draw.choice(["ed", "us", "ika"])]))
        rows.append((i, " ".join(words) + ".", int(toxic)))
    return rows


def frames(spark, rows):
    docs = spark.createDataFrame([(i, t, 0.1, 9, 8, 7) for i, t, _ in rows], DOCS)
    return docs, spark.createDataFrame([(i, y, 0, "x") for i, _, y in rows if i % 5], LABELS)


def test_learns_words_and_stems(spark):
    rows = made(1, 600)
    docs, labels = frames(spark, rows)
    model = toxicity.learn(docs, labels)
    assert any(t.startswith("grawl") for t in model[0])
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    held = [(i, y) for i, _, y in rows if i % 5 == 0]
    assert sum((scores[i] >= 0.5) == bool(y) for i, y in held) >= 0.98 * len(held)
    kept = toxicity.accepted(docs, model)
    assert kept.schema == docs.schema and {r["doc_id"] for r in kept.collect()} == {i for i in scores if scores[i] < 0.5}


def test_held_out_accuracy_of_the_query(spark):
    folder = "/root/testdata/sf0.1"
    got = queries.op5_toxicity(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out AND toxic IS NOT NULL").toPandas()
    ranks, ones = got.score.rank(), int(got.toxic.sum())
    auc = (ranks[got.toxic == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(got) - ones))
    assert auc >= 0.93 and (got.predicted == got.toxic).mean() >= 0.95


def weight(text, terms=None):
    grammar = toxicity.Grammar(terms or {})
    return grammar.clause_weight([grammar.symbol(w) for w in toxicity.TOKENS.findall(text.lower())])


def test_transducers():
    plain = weight("total idiot")
    assert plain == toxicity.GENERAL_WEIGHT
    assert weight("you are an idiot") == plain * toxicity.TARGETED
    assert weight("not an idiot") == plain * toxicity.NEGATED
    assert weight("not one of so many long words an idiot") == plain  # too far away
    assert weight("report said idiot") == plain * toxicity.REPORTED
    assert weight("we will kill them") == toxicity.THREAT_WEIGHT * toxicity.TARGETED
    assert weight("kill the lights") == 0
    assert weight("grawlus", {"grawl*": 2.0}) == 2.0


def test_screen_finds_words_and_stems_only():
    grammar = toxicity.Grammar({"grawl*": 2.0})
    assert grammar.matches("x idiot.") and grammar.matches("grawlika") and not grammar.matches("xidiot idiotx xgrawl")


def test_odd_rows_and_no_labels(spark):
    rows = [(1, None), (2, ""), (3, "you idiot " * 30_000), (None, "clean"), (4, "clean"), (4, "clean"), (5, "İdiot \U0001f600")]
    docs = spark.createDataFrame([(i, t, 0.1, 9, 8, 7) for i, t in rows], DOCS)
    model = toxicity.learn(docs, spark.createDataFrame([(1, None, 0, "x"), (None, 1, 0, "x")], LABELS))
    found = toxicity.score(docs, model).collect()
    scores = {r["doc_id"]: r["score"] for r in found}
    assert len(found) == len(rows) and all(0 <= s <= 1 for s in scores.values())
    assert scores[3] > 0.5 > scores[1] == scores[2] == scores[4] == scores[None]
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_sample_is_bounded_and_copies_count_once(spark):
    rows = [(i, f"copy of the same text {'idiot' if i % 2 else ''}", i % 2) for i in range(60)] + [(100 + i, f"own text w{i}a", 0) for i in range(40)]
    docs, _ = frames(spark, rows)
    labels = spark.createDataFrame([(i, y, 0, "x") for i, _, y in rows], LABELS)
    assert toxicity.labelled_sample(docs, labels, 1000).where("toxic = 1").count() == 1
    assert toxicity.labelled_sample(docs, labels, 10).count() <= 20


def test_rows_that_share_a_passage_all_stay_in_the_sample(spark):
    passage = " ".join(FILLER)
    rows = [(i, f"{passage} own{i}a {'idiot' if i % 2 else ''}", i % 2) for i in range(80)]
    rows += [(100 + i, f"{passage.upper()} own{i}a  {'idiot' if i % 2 else ''}", i % 2) for i in range(80)]  # the same words
    docs, _ = frames(spark, rows)
    labels = spark.createDataFrame([(i, y, 0, "x") for i, _, y in rows], LABELS)
    found = [(r["text"], r["toxic"], r["fold"]) for r in toxicity.labelled_sample(docs, labels, 1000).collect()]
    assert sorted((t, y) for t, y, _ in found) == sorted((t, y) for i, t, y in rows if i < 100)
    again = toxicity.labelled_sample(docs.orderBy(docs.doc_id.desc()), labels, 1000).collect()
    assert sorted((r["text"], r["toxic"], r["fold"]) for r in again) == sorted(found)


@pytest.mark.parametrize("counts", [[("lowei*", 90, 0), ("lowe*", 91, 60), ("loweitas", 40, 0), ("rare", 2, 0), ("common", 50, 900)]])
def test_choose_terms(counts):
    assert list(toxicity.choose_terms(counts, 100, 1000)) == ["lowei*"]


def test_fit_separates():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(500, 2))
    y = (x[:, 0] + 0.1 * draw.normal(size=500) > 0).astype(float)
    w = toxicity.fit(x, y)
    assert ((w[0] + x @ np.array(w[1:]) > 0) == (y == 1)).mean() > 0.95
