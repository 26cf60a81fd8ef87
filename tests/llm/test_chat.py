import random
from hashlib import sha256

import compare
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from costledger.llm import chat, queries
from costledger.llm.oracle import ORACLE

MESSAGES = "tree long, id long, parent long, role string, text string, score double, up long, leaf string"


def test_query_equals_sql(spark, sf):
    assert compare.differences(queries.op3_chat(spark, sf), compare.connect(sf), ORACLE["op3_chat"]) == []


def plain_best(rows):
    """Tree -> texts of the path with the highest mean score, ties to the smaller leaf."""
    best = {}
    for tree in {r[0] for r in rows}:
        nodes = {r[1]: r for r in rows if r[0] == tree}
        parents = {r[2] for r in nodes.values()}
        found = []
        for leaf in nodes:
            path, at = [], leaf
            while at in nodes and len(path) <= len(nodes):
                path.append(nodes[at])
                at = nodes[at][2]
            if leaf not in parents and len(path) <= len(nodes):
                found.append((-sum(p[5] or 0.0 for p in path) / len(path), leaf, [p[4] or "" for p in reversed(path)]))
        if found:
            best[tree] = min(found)[2]
    return best


def test_best_path_of_random_trees(spark):
    draw = random.Random(3)
    rows = []
    for tree in range(12):
        for i in range(draw.choice([1, 2, 9, 40])):
            parent = draw.choice([None, *range(i)]) if i else None
            rows.append((tree, i, parent, draw.choice(["user", "assistant"]), f"{tree}.{i}", float(draw.randint(0, 8)), 1, "x"))
    rows += [(50, i, i - 1 if i else None, "user", f"c{i}", 1.0, 1, "x") for i in range(70)]  # a long chain
    rows += [(51, 1, 2, "user", "a", 1.0, 1, "x"), (51, 2, 1, "user", "b", 1.0, 1, "x"), (51, 3, 99, "user", "orphan", 1.0, 1, "x")]  # a cycle
    got = {r["tree"]: [t for _, t in chat.read_turns(r["formatted"])] for r in chat.format_trees(spark.createDataFrame(rows, MESSAGES)).collect()}
    assert got == plain_best(rows)


def test_several_branches_are_ranked(spark):
    rows = [(1, 0, None, "user", "q", 0.0, 1, ""), (1, 1, 0, "assistant", "bad", 1.0, 1, ""), (1, 2, 0, "assistant", "good", 5.0, 1, ""), (1, 3, 0, "assistant", "tie", 5.0, 1, "")]
    found = chat.format_trees(spark.createDataFrame(rows, MESSAGES), branches=2).orderBy("rank").collect()
    assert [(r["leaf"], r["rank"], r["n_turns"]) for r in found] == [(2, 1, 2), (3, 2, 2)]
    assert [found[0]["formatted"][s["start"] : s["end"]] for s in found[0]["loss_spans"]] == ["good"]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="\\<>|[]/sINTendturx\n ", max_size=25), min_size=1, max_size=4))
def test_texts_come_back(texts):
    escaped = []
    for text in texts:
        text = text.replace("\\", "\\\\")
        for control in chat.CONTROLS:
            text = text.replace(control, control[0] + "\\" + control[1:])
        assert not any(c in text for c in chat.CONTROLS)
        escaped.append(text)
    formatted = "".join(f"{chat.TURN}user{chat.TEXT}{t}{chat.END}\n" for t in escaped)
    assert chat.read_turns(formatted) == [("user", t) for t in texts]


def test_control_strings_nulls_and_repeated_rows(spark):
    odd = "".join(chat.CONTROLS) + "\\[INST]\\\\ \\<s>\n<|text|>é\U0001f600"
    turns = [
        (1, 0, "user", odd, "x"), (1, 1, "assistant", odd, "x"), (1, 2, None, None, "x"), (2, None, "assistant", "", "x"), (2, 5, "assistant", "b", "x"), (2, 5, "assistant", "b", "x"),
        (None, 0, "<|end|>", "t", "x"), (3, 0, "assistant", "y" * 200_000, "x"),
    ]
    found = chat.read_back(chat.format_trees(chat.reply_chain(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, id string"))))
    got = {r["tree"]: r for r in found.collect()}
    digest = lambda t: sha256(t.encode()).hexdigest()
    assert set(got) == {1, 2, 3, None}
    assert got[1]["turns_sha256"] == digest(f"user\n{odd}\nassistant\n{odd}\n\n\n") and got[1]["loss_sha256"] == digest(odd) and got[1]["loss_chars"] == len(odd)
    assert got[2]["n_turns"] == 3 and got[2]["loss_sha256"] == digest("bb")
    assert got[None]["turns_sha256"] == digest("<|end|>\nt\n") and got[None]["loss_chars"] == 0
    assert got[3]["loss_chars"] == 200_000


@pytest.mark.parametrize("schema", ["conv_id long, turn long, role string, text string"])
def test_empty_table(spark, schema):
    assert chat.read_back(chat.format_trees(chat.reply_chain(spark.createDataFrame([], schema)))).count() == 0
