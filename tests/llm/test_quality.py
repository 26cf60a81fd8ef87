import random
from collections import Counter

import pytest

from costledger.llm import queries, quality

DOCS = "doc_id long, text string, n_words string, kept int, rule string"
PROSE = "The harbour was quiet in the morning. Boats came in one after the other, and the nets were hung up to dry. "


def cleaned(spark, texts, **options):
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in enumerate(texts)], DOCS)
    return {r["doc_id"]: r.asDict() for r in quality.clean_documents(docs, **options).collect()}


def plain_counts(text):
    """The base figures, counted window by window."""
    text = text or ""
    strip = " \t\n\x0b\x0c\r"
    lines = text.split("\n")
    words = [w for w in text.translate(dict.fromkeys(map(ord, strip), " ")).split(" ") if w]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    with_words = [x for x in lines if x.strip(strip)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": sum(x in with_words[:i] for i, x in enumerate(with_words)),
        "n_repeat_words": len(inside),
        "base_failed": len(words) < 20 or 100 * len(inside) > 30 * len(words),
    }


def test_counts_equal_a_plain_version(spark):
    draw = random.Random(5)
    pieces = ["a", "b", "é", "c.", "#", "\n", " ", "\t", " ", "|", "\x0b", "d!!"]
    texts = ["".join(draw.choice(pieces) + draw.choice(["", " "]) for _ in range(draw.choice([0, 3, 30, 200]))) for _ in range(150)]
    texts += [None, "", " \n\n ", "\x1c", PROSE, PROSE * 5, "one two three four five six seven eight " * 2 + "x"]
    for i, row in cleaned(spark, texts).items():
        want = plain_counts(texts[i])
        assert {k: row[k] for k in want} == want, texts[i]


@pytest.mark.parametrize(
    ("line", "rule"),
    [
        ("A sentence with an end.", None),
        ("He said: “no.”", None),
        ("Two sentences. The second one lacks its stop", None),
        ("a title without any stop", "punctuation"),
        ("buy### now$$$ cheap*** here&&& end.", "punctuation"),
        ("WOW!! GREAT!! BUY!! NOW!!", "punctuation"),
        ("Home | News. | Sport | Weather", "navigation"),
        ("The price of a | b was compared with the price of c in a long and winding sentence.", None),
        ("Older posts. » Newer posts » Top", "navigation"),
        ("All Rights Reserved by the owner.", "boilerplate"),
        ("Please accept cookies.", "boilerplate"),
        ("When all rights reserved by a treaty are listed in one long paragraph that speaks about the history of law in the coastal towns of the north, nothing is removed.", None),
    ],
)
def test_rules_of_a_line(line, rule):
    assert quality.failed_rule(line, line.split()) == rule


def test_lines_go_before_documents(spark):
    menu = "Home | News. | Sport | Weather"
    some, most = f"{menu}\n{PROSE}\n{PROSE}", "\n".join([f"Home{i} | News{i}. | Sport{i} | Weather{i}" for i in range(20)] + [PROSE])
    rows = cleaned(spark, [some, most, PROSE + "\n" + PROSE])
    assert rows[0]["base_failed"] and rows[0]["text"] == PROSE  # the copy of a line goes too
    longer = f"{menu}\n" + "\n".join(PROSE.replace("the", f"the{k}").replace("in", f"in{k}") for k in "abc")
    kept = cleaned(spark, [longer, most])
    assert kept[0]["kept"] and kept[0]["removed_navigation"] == 1 and menu not in kept[0]["text"]
    assert not kept[1]["base_failed"] and not kept[1]["kept"]


def test_odd_rows_and_extra_columns(spark):
    rows = [(None, None, "x", 1, "y"), (None, None, "x", 1, "y"), (4, PROSE, "x", 1, "y"), (4, PROSE, "x", 1, "y")]
    found = quality.clean_documents(spark.createDataFrame(rows, DOCS)).collect()
    assert Counter((r["doc_id"], r["n_words"], r["kept"]) for r in found) == {(None, 0, False): 2, (4, 22, True): 2}
    empty = quality.clean_documents(spark.createDataFrame([], DOCS))
    assert empty.count() == 0 and "text" in empty.columns
    assert "text" not in quality.clean_documents(spark.createDataFrame([], DOCS), with_text=False).columns


def test_a_very_long_text(spark):
    text = "\n".join(f"Line {i} tells of day {i}." for i in range(60_000))
    row = cleaned(spark, [text])[0]
    assert (row["n_words"], row["n_lines"], row["n_repeat_words"], row["kept"]) == (360_000, 60_000, 0, True)


def test_clean_labelled_documents_stay(spark, sf):
    rows = queries.op11_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    good, bad = rows.where("quality = 1"), rows.where("quality = 0")
    assert good.where("NOT kept AND NOT base_failed").count() == 0
    assert bad.where("kept").count() <= 0.05 * bad.count()
