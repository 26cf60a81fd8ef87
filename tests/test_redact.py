import random
import re

import pyarrow as pa
import pytest

from costledger.functions.redaction import KeyFilter, index_keys, pieces, replace_keys, replace_words
from costledger.operators import redact as R
from costledger.operators.redact import pii_dictionary, redact

PEOPLE = [
    ("Ann", "Lee", "100", "ann.lee-x@a.b"),
    ("ann ", "van der Berg", "20", None),
    ("José", "O'Brien", "7", "plain"),
    ("Jr.", " ", None, "jo_smith@x"),
    ("Zed", "100", "5", ""),
]


def _by_regex(text, aliases):
    """All keys in one alternation, longest first: what replacing must be equal to."""
    keys = sorted(aliases, key=len, reverse=True)
    pattern = re.compile(r"\b(" + "|".join(map(re.escape, keys)) + r")\b", re.IGNORECASE)
    return pattern.sub(lambda m: aliases.get(m.group(0).lower(), m.group(0)), text)


def test_replacing_equals_an_alternation():
    rng = random.Random(3)
    parts = ["a", "b", "Ab", "-", ".", "_", " ", "  ", "é", "1"]
    for _ in range(20_000):
        keys = {"".join(rng.choice(parts) for _ in range(rng.randint(1, 4))).strip() for _ in range(5)} - {""}
        aliases = {k.lower(): f"<{i}>" for i, k in enumerate(sorted(keys))}
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert replace_keys(text, aliases, index_keys(aliases)) == _by_regex(text, aliases), (aliases, text)


def test_longest_key_first():
    aliases = {"ann": "A", "ann lee": "B"}
    assert replace_keys("ANN LEE met Ann. Annex", aliases, index_keys(aliases)) == "B met A. Annex"
    assert replace_words("Ann, annex JOSÉ", {"ann": "A", "josé": "J"}) == "A, annex J"


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(PEOPLE, "`First Name` string, `Family Name` string, `Staff ID` string, email string")


def test_dictionary(people):
    rows = pii_dictionary(people).collect()
    got = {r["key_lower"]: (r["key"], r["alias"], r["is_id"]) for r in rows}
    names = {"Ann", "Lee", "ann", "lee", "van der Berg", "José", "O'Brien", "Jr.", "smith", "Zed", "100"}
    ordered = sorted(names, key=lambda k: (-len(k), k))
    number = {k: i for i, k in enumerate(ordered, 1)}
    want = {}
    for key in ordered:
        want[key.lower()] = (key, f"RedactedName_{number[key]}", False)
    for i, key in enumerate(sorted({"100", "20", "7", "5"}), 1):
        want[key] = (key, f"9{i:06d}", True)
    assert got == want


TEXTS = [
    "ANN LEE met Ann.", "Annex", None, "", "Mr van der  Berg and Van der Berg, O'Brien's 100 and 7.5", "JOSÉ josé Jose",
    "Jr. Jr.x jo smith zed_", "20 Lee-Ann",
]


@pytest.mark.parametrize("way", ["small", "large", "salted"])
def test_all_ways_agree(spark, people, way, monkeypatch):
    dictionary = pii_dictionary(people)
    aliases = {r["key_lower"]: r["alias"] for r in dictionary.collect()}
    used = []
    large = R._redact_large
    monkeypatch.setattr(R, "_redact_large", lambda *a: used.append("large") or large(*a))
    total = sum(len(k) + len(a) for k, a in aliases.items())
    limit = {"small": total, "large": total - 1, "salted": 0}[way]
    if way == "salted":
        monkeypatch.setattr(R, "HOT_SHARE", 10**6)  # each key is spread over as many tasks as it has hits
    df = spark.createDataFrame([(i, t, t) for i, t in enumerate(TEXTS)], "i int, a string, `b c` string").repartition(3)
    rows = redact(df, dictionary, max_broadcast_chars=limit).orderBy("i").collect()
    want = [t and _by_regex(t, aliases) for t in TEXTS]
    assert [r["a"] for r in rows] == want and [r["b c"] for r in rows] == want
    assert used == ([] if way == "small" else ["large"])


def test_a_filter_holds_all_keys_and_few_others(spark):
    keys = [f"key{i}" for i in range(3000)] + [f"two words{i}" for i in range(500)]
    dictionary = spark.createDataFrame([(k, k) for k in keys], "key string, key_lower string")
    known = KeyFilter(*R._key_filter(dictionary, len(keys)))
    assert all(known.candidates([f"x {k.upper()}."], [1, 3]) == [k] for k in keys)
    wrong = sum(bool(known.candidates([f"other{i}"], [1, 3])) for i in range(20_000))
    assert wrong < 200


def test_a_full_filter_loses_nothing(spark, people, monkeypatch):
    monkeypatch.setattr(R, "_key_filter", lambda *a: (1 << 15, {1: b"\xff" * 4096}))
    dictionary = pii_dictionary(people)
    df = spark.createDataFrame([(t,) for t in TEXTS], "a string").coalesce(1)
    got = redact(df, dictionary, max_broadcast_chars=0).collect()
    assert sorted(str(r["a"]) for r in got) == sorted(str(r["a"]) for r in redact(df, dictionary).collect())


def test_other_headers(spark):
    df = spark.createDataFrame([("Ann", "ann.leigh@x")], "`First Name` string, Work_Email string")
    keys = {r["key"] for r in R.pii_keys(df, {"Work_Email": "email"}).collect()}
    assert keys == {"Ann", "ann", "leigh"}


def test_empty_dictionary_changes_nothing(spark, people):
    df = spark.createDataFrame([("Ann",)], "a string")
    assert redact(df, pii_dictionary(people).where("false")).collect() == df.collect()


def test_redacting_again_changes_nothing(spark, people):
    dictionary = pii_dictionary(people)
    df = spark.createDataFrame([(t,) for t in TEXTS], "a string")
    once = redact(df, dictionary)
    assert redact(once, dictionary).collect() == once.collect()


def test_people_of_the_given_tables(spark, sf):
    """The query without SQL counterpart, against the alternation on whole texts."""
    from costledger.plans import queries, views

    dictionary = pii_dictionary(views.view(spark, sf, views.PEOPLE_RAW))
    aliases = {r["key_lower"]: r["alias"] for r in dictionary.collect()}
    texts = {
        (r["conv_id"], r["turn"]): r["text"] for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()
    }
    got = {(r["conv_id"], r["turn"]): r["text"] for r in queries.redacted_conversations(spark, sf).collect()}
    assert got == {k: t and _by_regex(t, aliases) for k, t in texts.items()}


@pytest.mark.parametrize("limit", [R.MAX_BROADCAST_CHARS, 0])
def test_keys_whose_lower_case_has_more_runs(spark, limit):
    dictionary = spark.createDataFrame([("İnci", "İnci".lower(), "R_1", False), ("Öz", "öz", "R_2", False)], "key string, key_lower string, alias string, is_id boolean")
    df = spark.createDataFrame([("İnci Öz phoned",), ("xİnci inci ÖZ",)], "t string")
    assert [r["t"] for r in redact(df, dictionary, max_broadcast_chars=limit).collect()] == ["R_1 R_2 phoned", "xİnci inci R_2"]


def test_pieces_hold_all_rows_in_order():
    texts = pa.array([None, "", "éé", "x" * 50, "a", "b", None, "c" * 9, ""]).slice(1)
    others = pa.array([None, "x", "é", None, "y", "z", "z", None, None]).slice(1)
    got = list(pieces([texts, others], texts, max_bytes=10))
    assert [t for piece in got for t in piece[0].to_pylist()] == texts.to_pylist()
    assert [t for piece in got for t in piece[1].to_pylist()] == others.to_pylist()
    assert all(piece[2].equals(piece[0]) for piece in got)
    sizes = [sum(len(t.encode()) for c in piece[:2] for t in c.to_pylist() if t) for piece in got]
    assert [n for n in sizes if n > 10] == [50] and len(got) == 4
    assert list(pieces([texts.slice(0, 0)])) == []


def test_a_task_holds_some_texts_of_a_batch_only(spark, monkeypatch):
    def memory_and_text(text, aliases):
        with open("/proc/self/statm") as file:
            return f"{int(file.read().split()[1]) * 4096} {text}"

    monkeypatch.setattr(R, "replace_words", memory_and_text)
    dictionary = spark.createDataFrame([("Ann", "ann", "R_1")], "key string, key_lower string, alias string")
    # 20 MB, and 80 MB as Python strings
    df = spark.range(0, 400, 1, 1).selectExpr("concat(chr(65 + id % 26), '\U0001f600', repeat('x', 50000)) AS t")
    rows = redact(df, dictionary).selectExpr("cast(split_part(t, ' ', 1) AS bigint) AS used", "length(t) AS n").collect()
    assert len(rows) == 400 and all(r["n"] > 50_000 for r in rows)
    assert max(r["used"] for r in rows) - rows[0]["used"] < 40_000_000


@pytest.mark.parametrize("limit", [R.MAX_BROADCAST_CHARS, 0])
def test_one_python_worker_a_task_for_all_columns(spark, people, limit):
    dictionary = pii_dictionary(people)
    aliases = {r["key_lower"]: r["alias"] for r in dictionary.collect()}
    df = spark.createDataFrame([(t, t, i) for i, t in enumerate(TEXTS)], "_texts string, `B.c` string, i int")
    out = redact(df, dictionary, max_broadcast_chars=limit)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"EvalPython", plan)) == 1
    assert out.schema == df.schema
    want = [t and _by_regex(t, aliases) for t in TEXTS]
    assert [tuple(r) for r in out.orderBy("i").collect()] == [(t, t, i) for i, t in enumerate(want)]
