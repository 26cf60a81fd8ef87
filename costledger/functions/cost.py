"""Cost per student and band memberships."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from costledger.functions.numbers import fixed_text

OK = "OK"
NO_ACTIVITY = "No activity"
UNDEFINED = "Undefined (0 students)"


def cost_per_student(cost: Column, students: Column) -> Column:
    return F.when(students > 0, F.try_divide(cost, students.cast("double"))).when(cost == 0.0, F.lit(0.0))


def cost_status(cost: Column, students: Column) -> Column:
    return F.when(students > 0, OK).when(cost == 0.0, NO_ACTIVITY).otherwise(UNDEFINED)


def is_usable(x: Column) -> Column:
    """Present, finite and above zero."""
    return x.isNotNull() & ~F.isnan(x) & (x > 0.0) & (x < float("inf"))


def _step(condition: Column) -> Column:
    return F.when(condition, 1.0).otherwise(0.0)


def membership_low(x: Column, low: Column, mid: Column) -> Column:
    """1 up to ``low``, 0 from ``mid``, linear in between."""
    return (
        F.when(mid <= low, _step(x <= low))
        .when(x <= low, 1.0)
        .when(x >= mid, 0.0)
        .otherwise(F.try_divide(mid - x, mid - low))
    )


def membership_high(x: Column, mid: Column, high: Column) -> Column:
    """0 up to ``mid``, 1 from ``high``, linear in between."""
    return (
        F.when(high <= mid, _step(x >= high))
        .when(x <= mid, 0.0)
        .when(x >= high, 1.0)
        .otherwise(F.try_divide(x - mid, high - mid))
    )


def membership_medium(x: Column, low: Column, mid: Column, high: Column) -> Column:
    """A triangle over the three anchors; with anchors that coincide, 1 at ``mid`` only."""
    return (
        F.when((mid <= low) | (high <= mid), _step(x == mid))
        .when((x <= low) | (x >= high), 0.0)
        .when(x <= mid, F.try_divide(x - low, mid - low))
        .otherwise(F.try_divide(high - x, high - mid))
    )


def band(low: Column, medium: Column, high: Column) -> Column:
    """The largest membership; Medium wins ties, then Low."""
    return (
        F.when((medium >= low) & (medium >= high), "Medium").when(low >= high, "Low").otherwise("High")
    )


def band_score(name: Column) -> Column:
    return F.when(name == "Low", 0.0).when(name == "Medium", 0.5).otherwise(1.0)


def anchor_text(low: Column, median: Column, high: Column, places: int = 4) -> Column:
    values = [fixed_text(c, places) for c in (low, median, high)]
    text = F.concat(F.lit("min "), values[0], F.lit(", median "), values[1], F.lit(", max "), values[2])
    return F.when(low.isNull(), "No finite positive values").otherwise(text)
