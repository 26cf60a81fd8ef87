"""Chat formatting of reply trees.

Messages name their parent. Iterative self-joins by pointer doubling find each message's distance to its root and the sum of the scores
above it, so a path of n messages takes about log2(n) joins of id rows; texts are joined at the end. The branches of a tree (its leaves) are ranked
by the mean score of their paths, and each chosen path becomes one conversation.

The template writes a turn as ``<|turn|>role<|text|>text<|end|>`` and a newline. Control strings (its own and those of other common templates)
inside roles and texts are broken by a backslash after their first character; backslashes are doubled. Both are undone on reading.

Defined cases: a NULL text or role is empty; a NULL tree id is a tree of its own; a message whose parent does not exist in its tree is a root;
messages of a cycle have no root, so they are in no path; of repeated ids in a tree the row with the smallest parent, role and text stays; ties between branches go to the smaller
leaf id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costledger.llm.common import in_batches, stored

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Control strings of common chat templates (fixed values).
CONTROLS = (
    TURN, TEXT, END, "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>", "<|system|>", "<|user|>", "<|assistant|>",
    "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
)
TRAINED_ROLE = "assistant"
#: Turn of a formatted conversation, and a mark or a doubled backslash.
READ_TURN = re.compile(re.escape(TURN) + "(.*?)" + re.escape(TEXT) + "(.*?)" + re.escape(END) + "\n", re.S)
READ_ESCAPE = re.compile(r"\\(\\?)")


def escape(text: Column) -> Column:
    """Doubles backslashes and puts one after the first character of each control string."""
    text = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for control in CONTROLS:
        text = F.replace(text, F.lit(control), F.lit(control[0] + "\\" + control[1:]))
    return text


def unescape(text: str) -> str:
    return READ_ESCAPE.sub(lambda m: m.group(1), text)


def reply_chain(turns: DataFrame) -> DataFrame:
    """Messages of linear conversations (``conv_id``, ``turn``, ``role``, ``text``): each answers the one before it."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    numbered = turns.select("conv_id", F.row_number().over(order).cast("long").alias("id"), "role", "text")
    parent = F.when(F.col("id") > 1, F.col("id") - 1)
    return numbered.select(F.col("conv_id").alias("tree"), "id", parent.alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def doubled_ancestors(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The ancestors 2^k steps above, and all messages whose paths are known to the root.

    Tables k = 0, 1, ... have ``tree``, ``id``, ``up`` (the ancestor), ``steps`` and ``total`` (length and score of the path below it) of the messages
    that have such an ancestor; only these are joined again, so a few deep trees cost little. The others, with ``steps`` and ``total`` up to and
    with the root, are in the second result; messages of a cycle are not.
    """
    columns = ["tree", "id", "up", "steps", "total"]
    own = nodes.select(F.col("tree").alias("p_tree"), F.col("id").alias("p_id"))
    exists = F.col("tree").eqNullSafe(F.col("p_tree")) & (F.col("parent") == F.col("p_id"))
    first = nodes.join(own, exists, "left").select("tree", "id", F.col("p_id").alias("up"), F.lit(1).cast("long").alias("steps"), F.col("score").alias("total"))
    rows = stored(first, "chat_up")
    most = rows.groupBy("tree").count().agg(F.max("count")).first()[0] or 0  # a path is no longer than its tree
    done, levels = rows.where("up IS NULL"), []
    active = rows.where("up IS NOT NULL")
    while active.limit(1).count() and 2 ** len(levels) <= most:
        levels.append(active)
        above = active.union(done).select(*[F.col(c).alias(f"a_{c}") for c in columns])
        met = F.col("tree").eqNullSafe(F.col("a_tree")) & (F.col("up") == F.col("a_id"))
        sums = [(F.col(c) + F.col(f"a_{c}")).alias(c) for c in ("steps", "total")]
        rows = stored(active.join(above, met).select("tree", "id", F.col("a_up").alias("up"), *sums), "chat_up")
        done, active = done.union(rows.where("up IS NULL")), rows.where("up IS NOT NULL")
    return levels, done


def best_branches(nodes: DataFrame, whole: DataFrame, branches: int) -> DataFrame:
    """``tree``, ``leaf``, ``rank``, ``score``: the leaves whose paths have the highest mean score."""
    parents = nodes.where("parent IS NOT NULL").select(F.col("tree").alias("p_tree"), F.col("parent").alias("p_id")).distinct()
    is_parent = F.col("tree").eqNullSafe(F.col("p_tree")) & (F.col("id") == F.col("p_id"))
    leaves = whole.join(parents, is_parent, "left_anti")
    scored = leaves.select("tree", F.col("id").alias("leaf"), (F.col("total") / F.col("steps")).alias("score"))
    order = Window.partitionBy("tree").orderBy(F.desc("score"), "leaf")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= branches)


def path_members(leaves: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """All messages of the paths from the leaves: ``tree``, ``leaf``, ``id``, ``back`` (steps from the leaf)."""
    members = leaves.select("tree", "leaf", F.col("leaf").alias("id"), F.lit(0).cast("long").alias("back"))
    for k in range(len(levels) - 1, -1, -1):
        up = levels[k].select(F.col("tree").alias("u_tree"), F.col("id").alias("u_id"), "up")
        same = F.col("tree").eqNullSafe(F.col("u_tree")) & (F.col("id") == F.col("u_id"))
        here = F.struct("id", "back")
        there = F.struct(F.col("up").alias("id"), (F.col("back") + 2**k).alias("back"))
        both = F.when(F.col("up").isNull(), F.array(here)).otherwise(F.array(here, there))
        members = members.join(up, same, "left").select("tree", "leaf", F.explode(both).alias("m")).select("tree", "leaf", "m.id", "m.back")
    return members


def format_trees(messages: DataFrame, branches: int = 1) -> DataFrame:
    """One row per chosen path: ``tree``, ``leaf``, ``rank``, ``score``, ``n_turns``, ``formatted`` and ``loss_spans``.

    ``messages``: ``tree``, ``id`` (long), ``parent``, ``role``, ``text``, ``score``. ``loss_spans`` are start and end (code points) of the trained texts
    in ``formatted``, without the marks of the template.
    """
    whole = F.min(F.struct("parent", "role", "text", "score")).alias("m")
    messages = stored(messages.groupBy("tree", "id").agg(whole).select("tree", "id", "m.*"), "chat_messages")
    nodes = messages.select("tree", "id", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    levels, whole = doubled_ancestors(nodes)
    leaves = best_branches(nodes, whole, branches)
    members = path_members(leaves, levels).withColumnsRenamed({"tree": "m_tree", "id": "m_id"})
    same = F.col("tree").eqNullSafe(F.col("m_tree")) & (F.col("id") == F.col("m_id"))
    role = F.coalesce("role", F.lit(""))
    head = F.concat(F.lit(TURN), escape(role), F.lit(TEXT))
    turn = F.struct((-F.col("back")).alias("at"), head.alias("head"), escape(F.col("text")).alias("body"), (role == TRAINED_ROLE).alias("trained"))
    turns = messages.join(members, same).select("tree", "leaf", turn.alias("turn"))
    paths = turns.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END + "\n"))), "")
    # each turn's span is relative to its own start; the running lengths move it
    size = lambda t: F.length(t["head"]) + F.length(t["body"]) + len(END) + 1
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    span = lambda s, t: F.struct((s["at"] + F.length(t["head"])).alias("start"), (s["at"] + F.length(t["head"]) + F.length(t["body"])).alias("end"))
    step = lambda s, t: F.struct((s["at"] + size(t)).alias("at"), F.when(t["trained"], F.concat(s["spans"], F.array(span(s, t)))).otherwise(s["spans"]).alias("spans"))
    spans = F.aggregate("turns", start, step, lambda s: s["spans"])
    formatted = paths.select("tree", "leaf", F.size("turns").cast("long").alias("n_turns"), text.alias("formatted"), spans.alias("loss_spans"))
    ranks = leaves.select(F.col("tree").alias("r_tree"), F.col("leaf").alias("r_leaf"), "rank", "score")
    chosen = F.col("tree").eqNullSafe(F.col("r_tree")) & (F.col("leaf") == F.col("r_leaf"))
    return formatted.join(ranks, chosen).drop("r_tree", "r_leaf")


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a formatted conversation."""
    return [(unescape(role), unescape(text)) for role, text in READ_TURN.findall(formatted)]


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the output says: ``tree``, ``n_turns``, ``turns_sha256``, ``loss_chars``, ``loss_sha256``, ``formatted_chars``."""
    from hashlib import sha256

    kind = dict(formatted.dtypes)["tree"]

    def digest(text: str) -> str:
        return sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                turns = read_turns(text)
                trained = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
                whole = "".join(f"{role}\n{body}\n" for role, body in turns)
                rows.append((len(turns), digest(whole), len(trained), digest(trained), len(text)))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["tree", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], names)

    schema = f"tree {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return in_batches(formatted.select("tree", "formatted", "loss_spans"), run, schema)
