"""Mixing sources to target weights by hash thresholds.

Every document has a fixed hash. The words of each source are summed by hash bucket (partial sums in the map tasks, at most
``BUCKETS`` rows a source), which shows in which bucket a budget's threshold lies. Only the documents of that bucket are summed again by the next
bits of the hash, until a bucket holds one hash value. The documents below the threshold are then taken by a plain filter: nothing is sorted,
and no group meets in one task. A larger budget has a higher threshold, so the sets are nested but for the documents at the thresholds.

A source has a threshold for each power of two of the document size (a stratum), all for the same part of their words. The document at a
threshold goes in or out so as to make up for the larger ones. What error is left is then taken from the budget of the smallest stratum that can hold
it, and the threshold of this one stratum is searched again, which leaves about half of one of its documents. Where no stratum has that many
words, the error stays.

Totals, budgets and boundaries of the sources are stored tables that are joined; the driver sees three numbers a round, whatever the number of sources.

A target above the source's size means whole repeats plus a part: every document is taken ``floor(target / size)`` times, and once more
if its hash lies below the threshold of the rest.

Defined cases: a NULL text has size 0; a NULL source is a source of its own and comes last; rows with equal ids have equal hashes, so
equal rows of a source are taken together; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costledger.llm.common import WORD_PATTERN, stored
from costledger.operators.numbering import number_sorted

#: Buckets of one level, a power of 16: a level reads the next hexadecimal digits of the hash.
DIGITS = 3
BUCKETS = 16**DIGITS
LEVELS = 5
WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
#: Rows of the tables per source (100 bytes each) that are sent to every task; larger ones are joined by shuffles.
BROADCAST_ROWS = 200_000
#: Names of added columns, which documents do not have.
OWN = "mixing__"
SIZE, HASH, STRATUM, REPEATS = (f"{OWN}{name}" for name in ("own_size", "own_hash", "own_stratum", "own_repeats"))


def word_count(text: str = "text") -> Column:
    """Number of words; NULL has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def shared(sources: DataFrame, cap: float, total: float) -> DataFrame:
    """``sources`` (``source_size``, ``weight``) with ``target``: ``total`` shared by weight.

    What exceeds ``cap`` times a size is shared again among the others, until nothing exceeds. A round finds the sources that are full with one
    aggregate; the share of the others only rises, so the full ones only grow in number.
    """
    full, known = F.lit(False), -1
    limit = F.lit(float(cap)) * F.col("source_size")
    while True:
        sums = sources.agg(
            F.count_if(full).alias("n"), F.sum(F.when(full, F.col("source_size"))).alias("size"), F.sum(F.when(~full, F.col("weight"))).alias("weight")
        ).first()
        if not sums["weight"]:
            return sources.withColumn("target", limit)
        rest = F.lit(float(total - cap * (sums["size"] or 0))) * F.col("weight") / F.lit(float(sums["weight"]))
        if sums["n"] <= known:
            return sources.withColumn("target", F.when(full, limit).otherwise(rest))
        full, known = rest > limit, sums["n"]


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = MOST_REPEATS, share: float = 1.0) -> DataFrame:
    """``source``, ``source_size``, ``target`` for each source; sources by code point, NULL last, take the weights in turn."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = number_sorted(totals, [F.col("source").asc_nulls_last()], "number")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("number", F.lit(len(weights))).cast("int") + 1)
    sources = stored(numbered.select("source", "source_size", weight.alias("weight")), "mix_sources")
    total = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    return shared(sources, cap, total).select("source", "source_size", "target")


def doc_hash(column: str = "doc_id") -> Column:
    """The first 15 hexadecimal digits of the md5 of the id as text."""
    return F.substring(F.md5(F.encode(F.coalesce(F.col(column).cast("string"), F.lit("")), "utf-8")), 1, DIGITS * LEVELS)


def stratum(size: Column) -> Column:
    """Number of bits of the size."""
    return F.length(F.bin(size))


def thresholds(sizes: DataFrame, budgets: DataFrame) -> DataFrame:
    """For each ``source`` and ``stratum``: ``bound`` and ``inclusive``, so that a source's words come near to the sum of its budgets.

    ``sizes`` has ``source``, ``stratum``, ``size`` and ``hash``, ``budgets`` has ``source``, ``stratum``, ``words`` and ``budget``. In the order of
    their hashes, the documents before the one that reaches the budget are taken, and this one too if that brings the source, from its large strata
    to its small ones, nearer to its budget. The error of all strata then moves the budget of the smallest one whose words allow it.
    """
    out, with_it = F.col("before") - F.col("budget"), F.col("before") + F.col("reached") - F.col("budget")
    first = _edges(sizes, budgets).withColumns({"left_out": out, "taken": with_it})
    # at most 64 strata a source
    members = F.struct((-F.col("stratum")).alias("at"), "stratum", "words", "budget", "bound", "left_out", "taken")
    grouped = first.groupBy("source").agg(F.sort_array(F.collect_list(members)).alias("strata"))
    empty = F.array().cast("array<struct<stratum:int,words:double,budget:double,bound:string,own:double,inclusive:boolean>>")

    def step(state: Column, s: Column) -> Column:
        inclusive = F.abs(state["error"] + s["taken"]) <= F.abs(state["error"] + s["left_out"])
        own = F.when(inclusive, s["taken"]).otherwise(s["left_out"])
        mark = F.struct(s["stratum"].alias("stratum"), s["words"].alias("words"), s["budget"].alias("budget"), s["bound"].alias("bound"), own.alias("own"), inclusive.alias("inclusive"))
        return F.struct((state["error"] + own).alias("error"), F.concat(state["marks"], F.array(mark)).alias("marks"))

    walked = grouped.select("source", F.aggregate("strata", F.struct(F.lit(0.0).alias("error"), empty.alias("marks")), step).alias("w"))
    # the budget of a stratum that has to make up for the errors of all others
    moved = lambda m: m["budget"] - (F.col("w.error") - m["own"])
    able = F.filter("w.marks", lambda m: (moved(m) > 0) & (moved(m) <= m["words"]))
    last = F.array_min(F.transform(able, lambda m: m["stratum"])).alias("last")
    marks = F.explode(F.transform("w.marks", lambda m: F.struct(m["stratum"].alias("stratum"), m["words"].alias("words"), moved(m).alias("budget"), m["bound"].alias("bound"), m["inclusive"].alias("inclusive"))))
    rows = stored(walked.select("source", last, marks.alias("m")).select("source", "last", "m.*"), "mix_walked")
    again = F.col("last").isNotNull() & (F.col("stratum") == F.col("last"))
    second = _edges(sizes, rows.where(again).select("source", "stratum", "words", "budget"))
    columns = ["source", "stratum", "bound", "inclusive"]
    ended = second.withColumn("inclusive", F.abs(with_it) <= F.abs(out)).select(columns)
    return stored(rows.where(~again).select(columns).union(ended), "mix_bounds")


def _edges(sizes: DataFrame, budgets: DataFrame) -> DataFrame:
    """``budgets`` with the hash (``bound``) at which the running sum of a stratum's words reaches them, the words ``before`` it and those it has (``reached``)."""
    open_ = stored(budgets.where("budget > 0").withColumns({"prefix": F.lit(""), "before": F.lit(0).cast("long")}), "mix_budgets")
    ends = None
    for level in range(LEVELS):
        found = stored(_boundaries(sizes, open_, DIGITS * level), "mix_boundaries")
        ended = found.where("low = high").select(*budgets.columns, "before", F.col("low").alias("bound"), "reached")
        ends = ended if ends is None else ends.union(ended)
        open_ = found.where("low <> high").select(*budgets.columns, F.concat("prefix", "bucket").alias("prefix"), "before")
        if open_.isEmpty():
            break
    return ends


def _boundaries(sizes: DataFrame, open_: DataFrame, at: int) -> DataFrame:
    """The bucket of the next hash digits in which the running sum of a stratum's words reaches the budget; a row per source and stratum."""
    keys = ["source", "stratum", "prefix"]
    known = _measured(open_.select(*[F.col(c).alias(f"k_{c}") for c in open_.columns]))
    same = [F.col("source").eqNullSafe(F.col("k_source")), F.col("stratum") == F.col("k_stratum"), F.col("prefix") == F.col("k_prefix")]
    rows = sizes.withColumn("prefix", F.substring("hash", 1, at) if at else F.lit(""))
    histogram = (
        rows.join(known, same, "left_semi")  # only documents of a boundary bucket are summed again
        .groupBy(*keys, F.substring("hash", at + 1, DIGITS).alias("bucket"))
        .agg(F.sum("size").alias("reached"), F.min("hash").alias("low"), F.max("hash").alias("high"))
    )
    order = Window.partitionBy(*keys).orderBy("bucket")  # at most BUCKETS rows each
    running = histogram.withColumn("sum", F.sum("reached").over(order)).join(known, same)
    before = F.col("k_before") + F.col("sum") - F.col("reached")
    columns = [*keys, F.col("k_words").alias("words"), F.col("k_budget").alias("budget"), "bucket", before.alias("before"), "reached", "low", "high"]
    return running.select(columns).where((F.col("before") < F.col("budget")) & (F.col("before") + F.col("reached") >= F.col("budget")))


def _measured(table: DataFrame) -> DataFrame:
    """A table with a few rows a source, to be broadcast if it is as small as it should be."""
    return F.broadcast(table) if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else table


def _with_numbers(docs: DataFrame) -> DataFrame:
    return docs.withColumns({SIZE: word_count(), HASH: doc_hash()}).withColumn(STRATUM, stratum(F.col(SIZE)))


def _joined(rows: DataFrame, sizes: DataFrame, weights: tuple[float, ...], cap: float, share: float) -> DataFrame:
    """``rows`` (a frame with the numbers of ``_with_numbers``) with the source's size and target and the document's repeats."""
    wanted = stored(targets(sizes, weights, cap, share), "mix_targets")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    wanted = wanted.withColumn("whole", whole.cast("long")).withColumnRenamed("source", "p_source")
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    strata = sizes.groupBy("source", "stratum").agg(F.sum("size").cast("double").alias("words"))
    budgets = strata.join(wanted, F.col("source").eqNullSafe(F.col("p_source")))
    budgets = budgets.select("source", "stratum", "words", F.try_divide(rest * F.col("words"), F.col("source_size")).alias("budget"))
    limits = thresholds(sizes, budgets)
    # both tables have a few rows a source; other names than the documents' columns may have
    known = wanted.select(*[F.col(c).alias(f"{OWN}{c}") for c in wanted.columns])
    bounds = limits.select(*[F.col(c).alias(f"{OWN}{c}") for c in limits.columns])
    same_stratum = F.col("source").eqNullSafe(F.col(f"{OWN}source")) & (F.col(STRATUM) == F.col(f"{OWN}stratum"))
    joined = rows.join(_measured(known), F.col("source").eqNullSafe(F.col(f"{OWN}p_source"))).join(_measured(bounds), same_stratum, "left")
    bound = F.col(f"{OWN}bound")
    below = (F.col(HASH) < bound) | (F.col(f"{OWN}inclusive") & (F.col(HASH) == bound))
    return joined.withColumn(REPEATS, F.col(f"{OWN}whole") + F.coalesce(below, F.lit(False)).cast("long"))


def _sizes(docs: DataFrame) -> DataFrame:
    rows = _with_numbers(docs.select("doc_id", "source", "text"))
    return stored(rows.select("doc_id", "source", F.col(SIZE).alias("size"), F.col(HASH).alias("hash"), F.col(STRATUM).alias("stratum")), "mix_sizes")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = MOST_REPEATS, share: float = 1.0) -> DataFrame:
    """Per document: ``doc_id``, ``size``, ``source_size``, ``target`` (of its source), ``repeats``, ``taken`` (words, repeats counted)."""
    sizes = _sizes(docs)
    rows = sizes.select("doc_id", "source", F.col("size").alias(SIZE), F.col("hash").alias(HASH), F.col("stratum").alias(STRATUM))
    joined = _joined(rows, sizes, weights, cap, share)
    named = [F.col(f"{OWN}{c}").alias(c) for c in ("source_size", "target")]
    columns = ["doc_id", F.col(SIZE).alias("size"), *named, F.col(REPEATS).alias("repeats")]
    return joined.select(*columns).withColumn("taken", F.col("size") * F.col("repeats"))


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = MOST_REPEATS, share: float = 1.0) -> DataFrame:
    """The documents of the mix with all their columns, each as often as it is taken. Texts are read twice and not shuffled."""
    joined = _joined(_with_numbers(docs), _sizes(docs), weights, cap, share)
    times = F.explode(F.array_repeat(F.lit(0), F.col(REPEATS).cast("int")))
    return joined.withColumn(f"{OWN}time", times).select(*docs.columns)
