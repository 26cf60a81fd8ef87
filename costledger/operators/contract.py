"""Contract rows: coercion, drop reasons, quality counters, cost per student by group."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costledger.functions import cost as C
from costledger.functions import numbers as N
from costledger.functions import text as X

KEPT = "kept"
SUMMARY = "summary row"
MISSING_KEY = "missing key"
NO_YEAR = "no year"
NEGATIVE = "negative students"

SUBJECT_KEYS = ["school", "subject_no", "subject", "year"]
SCHOOL_KEYS = ["school", "year"]


def known_headers(raw: DataFrame) -> DataFrame:
    """Columns with the names that the job reads, for headers in other spellings; unknown ones keep theirs."""
    return raw.withColumnsRenamed({c: X.HEADER_ALIASES.get(" ".join(c.split()).lower(), c) for c in raw.columns})


def classify_rows(raw: DataFrame) -> DataFrame:
    """Typed contract rows, each with the first reason to drop it or ``kept``.

    No shuffle, and each text is parsed once: counting and keeping are both done on the result.
    """
    keys = ["school", "subject_no", "subject"]
    typed = raw.select(
        *[X.ustrip(k).alias(k) for k in keys],
        X.extract_year("teaching_session").alias("year"),
        N.money("incl_oncosts").alias("cost"),
        N.head_count("student_count").alias("students"),
    )
    missing_key = reduce(or_, [F.col(k).isNull() | (F.col(k) == "") for k in keys])
    summary = F.lower("school").isin(*X.SUMMARY_WORDS) | F.lower("subject").isin(*X.SUMMARY_WORDS)
    reason = (
        F.when(summary, SUMMARY)
        .when(missing_key, MISSING_KEY)
        .when(F.col("year").isNull(), NO_YEAR)
        .when(F.col("students") < 0, NEGATIVE)
        .otherwise(KEPT)
    )
    return typed.withColumn("reason", X.computed_once(reason))


def clean_rows(classified: DataFrame) -> DataFrame:
    """The kept rows; a missing cost or count is 0."""
    return classified.where(F.col("reason") == KEPT).select(
        *SUBJECT_KEYS,
        F.coalesce("cost", F.lit(0.0)).alias("cost"),
        F.coalesce("students", F.lit(0)).try_cast("bigint").alias("students"),
    )


def accumulate(classified: DataFrame) -> DataFrame:
    """One grouped table, from one scan, that holds both the group sums and the row counters.

    Dropped rows carry NULL keys, so that they add a row per reason and not a row per key.
    """
    kept = F.col("reason") == KEPT
    counted = F.col("reason").isin(KEPT, NEGATIVE)
    return classified.groupBy(
        "reason", *[F.when(kept, F.col(k)).alias(k) for k in SUBJECT_KEYS]
    ).agg(
        *N.sum_parts("cost", F.coalesce("cost", F.lit(0.0))),
        F.try_sum(F.coalesce("students", F.lit(0).cast(N.COUNT))).alias("students"),
        F.count("*").alias("n_rows"),
        F.count_if(counted & F.col("cost").isNull()).alias("n_missing_cost"),
        F.count_if(counted & F.col("students").isNull()).alias("n_missing_students"),
    )


def _measures(grouped: DataFrame, keys: list[str]) -> DataFrame:
    totals = grouped.select(*keys, N.parts_total("cost").alias("total_oncosts"), "students")
    cost, students = F.col("total_oncosts"), F.col("students")
    return totals.select(
        *keys,
        "total_oncosts",
        students.try_cast("bigint").alias("total_students"),
        C.cost_per_student(cost, students).alias("oncosts_per_student"),
        C.cost_status(cost, students).alias("status"),
    )


def subject_year(accumulated: DataFrame) -> DataFrame:
    """Cost, students, cost per student and status by school, subject and year.

    The number of students is NULL where it passes 64 bits; cost per student and status come from the whole number.
    """
    return _measures(accumulated.where(F.col("reason") == KEPT), SUBJECT_KEYS)


def school_year(accumulated: DataFrame) -> DataFrame:
    """The same by school and year, added up from the finer groups rather than from the rows."""
    grouped = (
        accumulated.where(F.col("reason") == KEPT)
        .groupBy(*SCHOOL_KEYS)
        .agg(*N.merge_parts("cost"), F.try_sum("students").alias("students"))
    )
    return _measures(grouped, SCHOOL_KEYS)


def status_counts(subject_years: DataFrame, school_years: DataFrame) -> DataFrame:
    """Number of groups per status, at both grains."""
    both = subject_years.select(F.lit("subject_year").alias("grain"), "status").unionByName(
        school_years.select(F.lit("school_year").alias("grain"), "status")
    )
    return both.groupBy("grain", "status").agg(F.count("*").alias("n_groups"))


# Labels of the counters, in their order.
COUNTER_LABELS = {
    "rows_seen": "Rows seen (including dropped rows)",
    "dropped_missing_keys": "Rows dropped (missing School/Subject fields)",
    "dropped_missing_year": "Rows dropped (year not detected)",
    "dropped_summary_rows": "Rows dropped (summary rows: Total/Sum/Result)",
    "missing_cost": "Rows with missing cost values (treated as 0.0 for sums)",
    "missing_students": "Rows with missing student counts (treated as 0 for sums)",
    "negative_students": "Rows with negative student counts (dropped)",
    "subject_year_groups": "Subject-Year groups",
    "school_year_groups": "School-Year groups",
    "undefined_groups": "Groups with undefined cost per student (cost>0 and students==0)",
    "no_activity_groups": "Groups with no activity (cost==0 and students==0)",
}


def quality_counters(accumulated: DataFrame) -> DataFrame:
    """Metric and value, a row per counter.

    Everything is counted on the grouped table. School-years are counted in two steps, so that the distinct
    keys are spread over the tasks.
    """

    def rows_with(reason: str):
        return F.coalesce(F.sum(F.when(F.col("reason") == reason, F.col("n_rows"))), F.lit(0)).cast("bigint")

    kept = F.col("reason") == KEPT
    cost, students = N.parts_total("cost"), F.col("students")
    by_school = accumulated.groupBy("reason", *SCHOOL_KEYS).agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_missing_cost").alias("n_missing_cost"),
        F.sum("n_missing_students").alias("n_missing_students"),
        F.count("*").alias("n_groups"),
        F.count_if(C.cost_status(cost, students) == C.UNDEFINED).alias("n_undefined"),
        F.count_if(C.cost_status(cost, students) == C.NO_ACTIVITY).alias("n_no_activity"),
    )

    def total(name: str, condition=None):
        value = F.col(name) if condition is None else F.when(condition, F.col(name))
        return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")

    one_row = by_school.agg(
        total("n_rows").alias("rows_seen"),
        rows_with(MISSING_KEY).alias("dropped_missing_keys"),
        rows_with(NO_YEAR).alias("dropped_missing_year"),
        rows_with(SUMMARY).alias("dropped_summary_rows"),
        total("n_missing_cost").alias("missing_cost"),
        total("n_missing_students").alias("missing_students"),
        rows_with(NEGATIVE).alias("negative_students"),
        total("n_groups", kept).alias("subject_year_groups"),
        F.count_if(kept).alias("school_year_groups"),
        total("n_undefined", kept).alias("undefined_groups"),
        total("n_no_activity", kept).alias("no_activity_groups"),
    )
    return one_row.unpivot([], list(COUNTER_LABELS), "metric", "value")
