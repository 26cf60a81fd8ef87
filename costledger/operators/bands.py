"""Yearly anchors and fuzzy Low / Medium / High bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from costledger.functions import cost as C
from costledger.functions.numbers import round_exact
from costledger.session import materialise

# Values are counted by classes first: parts of an octave, so costs of any size are told apart, then equal parts of one class.
OCTAVE_PARTS = 64
CLASS_PARTS = 4096


def year_anchors(school_years: DataFrame) -> DataFrame:
    """Minimum, exact median and maximum of the usable costs per student, by year.

    The built-in ``median`` gathers all values of a year in one task. Here the costs are counted by classes of their value, and
    only the class that holds the rank looked for is divided again, until it is one value. Each round reads the costs of that
    class only and shuffles counts, at most a few thousand classes a year for all but the first. A double has 52 bits
    behind its exponent, so there are at most five rounds, whatever the values. Years without a usable cost get NULL anchors.
    """
    x = F.col("oncosts_per_student")
    costs = materialise(school_years.select("year", F.when(C.is_usable(x), x).alias("x")), "costs")
    counted = materialise(_classes(costs, ["year"], F.floor(F.log2("x") * OCTAVE_PARTS)), "classes")
    years = counted.groupBy("year").agg(F.min("lo").alias("anchor_min"), F.max("hi").alias("anchor_max"), F.sum("n").alias("n"))
    # the middle value, or the two next to the middle; the same row twice if the number is odd
    sides = F.array(F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2))
    ranks = years.where("n > 0").select("year", F.posexplode(sides).alias("side", "rank"))
    # years are four digits that start with 19 or 20: at most 200 rows, and 400 ranks
    targets = _holding(counted.join(F.broadcast(ranks), "year")).collect()
    middles = []
    while targets:
        middles += [(r["year"], r["lo"]) for r in targets if r["lo"] == r["hi"]]
        targets = [r for r in targets if r["lo"] < r["hi"]]
        if targets:
            targets = _divided(costs, targets).collect()
    kind = costs.schema["year"].dataType.simpleString()
    median = costs.sparkSession.createDataFrame(middles, f"year {kind}, middle double")
    # the two values in order, as the sum of more than two would depend on it
    halves = median.groupBy("year").agg(((F.min("middle") + F.max("middle")) / 2).alias("anchor_median"))
    return years.join(F.broadcast(halves), "year", "left").select("year", "anchor_min", "anchor_median", "anchor_max")


def _classes(costs: DataFrame, keys: list[str], number: Column) -> DataFrame:
    """How many costs each class has, and the least and greatest of them; a greater number has greater costs."""
    return costs.groupBy(*keys, number.alias("class")).agg(
        F.count("x").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")
    )


def _holding(counted: DataFrame) -> DataFrame:
    """The class that holds the rank of each year and side, and the rank within it."""
    below = F.sum("n").over(W.partitionBy("year", "side").orderBy("class")) - F.col("n")
    inside = F.col("rank") - F.col("below")
    return (
        counted.where("n > 0").withColumn("below", below)
        .where((inside >= 0) & (inside < F.col("n")))
        .select("year", "side", inside.alias("rank"), "lo", "hi")
    )


def _divided(costs: DataFrame, targets: list[Row]) -> DataFrame:
    """The part of each target's class that holds its rank: the least and the greatest cost of a class never share a part."""
    kind = costs.schema["year"].dataType.simpleString()
    schema = f"year {kind}, side int, rank bigint, lo double, hi double"
    within = costs.join(F.broadcast(costs.sparkSession.createDataFrame(targets, schema).withColumnsRenamed({"lo": "from", "hi": "to"})), "year")
    x, first, last = F.col("x"), F.col("from"), F.col("to")
    part = F.floor((x - first) / (last - first) * CLASS_PARTS)
    return _holding(_classes(within.where(x.between(first, last)), ["year", "side", "rank"], part))


def fuzzy_bands(school_years: DataFrame, anchors: DataFrame) -> DataFrame:
    """Memberships, band and score of each school and year with a usable cost and anchors.

    Memberships are unrounded here; ``rounded_bands`` gives the four-place form of the report.
    """
    x, low, mid, high = (F.col(c) for c in ("cost_per_student", "anchor_min", "anchor_median", "anchor_max"))
    rows = (
        school_years.where(C.is_usable(F.col("oncosts_per_student")))
        .select("school", "year", F.col("oncosts_per_student").alias("cost_per_student"))
        .join(F.broadcast(anchors.where(low.isNotNull())), "year")
    )
    return (
        rows.withColumns(
            {
                "mu_low": C.membership_low(x, low, mid),
                "mu_medium": C.membership_medium(x, low, mid, high),
                "mu_high": C.membership_high(x, mid, high),
            }
        )
        .withColumn("band", C.band(F.col("mu_low"), F.col("mu_medium"), F.col("mu_high")))
        .select(
            "school", "year", "cost_per_student", "mu_low", "mu_medium", "mu_high", "band",
            C.band_score(F.col("band")).alias("band_score"), "anchor_min", "anchor_median", "anchor_max",
        )
    )


def rounded_bands(bands: DataFrame, places: int = 4) -> DataFrame:
    columns = ["mu_low", "mu_medium", "mu_high", "anchor_min", "anchor_median", "anchor_max"]
    return bands.withColumns({c: round_exact(c, places) for c in columns})


def band_summary(bands: DataFrame) -> DataFrame:
    """Schools per band and year; all three bands are always columns."""
    return bands.groupBy("year").agg(
        *[F.count_if(F.col("band") == b).alias(b.lower()) for b in ("Low", "Medium", "High")],
        F.count("*").alias("total"),
    )


def anchor_lines(anchors: DataFrame, places: int = 4) -> DataFrame:
    """Year and its anchors as text."""
    text = C.anchor_text(F.col("anchor_min"), F.col("anchor_median"), F.col("anchor_max"), places)
    return anchors.select("year", text.alias("anchors"))
