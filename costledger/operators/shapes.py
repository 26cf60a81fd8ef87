"""Wide shapes: school by year matrix and subject report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costledger.functions.text import column_name

SUBJECT = ["school", "subject_no", "subject"]


def known_years(yearly: DataFrame) -> list[int]:
    """The years of a table that is already grouped by year, ascending: at most 200 by their pattern."""
    return sorted(r["year"] for r in yearly.select("year").distinct().collect())


def _at(year: int, value: str):
    return F.max(F.when(F.col("year") == year, F.col(value)))


def trend_matrix(school_years: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """A row per school with its cost per student in each year; a school without any stays.

    School and year are unique in the input, hence ``max`` picks the only value there is. Give ``years`` or a
    stored table: the list of columns must be known before the plan is built.
    """
    years = known_years(school_years) if years is None else years
    if not years:
        return school_years.select("school").distinct()
    return school_years.groupBy("school").agg(*[_at(y, "oncosts_per_student").alias(str(y)) for y in years])


def subject_report(subject_years: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """A row per subject with blocks of cost, cost per student and students for each year.

    Absent costs and students are 0, an absent cost per student stays NULL. The three blocks come out of one
    aggregation, without joins.
    """
    years = known_years(subject_years) if years is None else years
    if not years:
        return subject_years.select(*SUBJECT).distinct()
    zero = F.lit(0).cast("bigint")
    blocks = [
        *[
            F.coalesce(_at(y, "total_oncosts"), F.lit(0.0)).alias(column_name(y, "Incl Oncosts"))
            for y in years
        ],
        *[_at(y, "oncosts_per_student").alias(column_name(y, "Incl Oncosts Per Student")) for y in years],
        *[F.coalesce(_at(y, "total_students"), zero).alias(column_name(y, "Student Count")) for y in years],
    ]
    return subject_years.groupBy(*SUBJECT).agg(*blocks)


def long_report(subject_years: DataFrame) -> DataFrame:
    """The report in long form, a row per subject and year, for data with too many years to spread."""
    return subject_years.select(*SUBJECT, "year", "total_oncosts", "oncosts_per_student", "total_students")
