import math
import random
import statistics
import sys

import pytest
from pyspark.sql import functions as F

from costledger.operators import bands as B
from costledger.operators import contract as K
from costledger.operators import shapes as S
from costledger.schemas import CONTRACT_RAW

ROWS = [
    ("A", "1", "Maths", "Autumn 2020", "$1,000", "10"),
    (" A ", "1", "Maths", "Spring 2020", "500.5", "5.9"),
    ("A", "2", "Art", "2021", "0", "0"),
    ("B", "1", "Maths", "2020", "70", "0"),
    ("B", "1", "Maths", "2020", "n/a", None),
    ("Total", None, None, None, "9", "9"),
    ("C", "1", "result ", "2020", "9", "9"),
    (None, "1", "Maths", "2020", "9", "9"),
    ("C", " ", "Maths", "2020", "9", "9"),
    ("C", "1", "Maths", "TBA", "9", "9"),
    ("C", "1", "Maths", "2020", "x", "-3"),
]


@pytest.fixture
def grouped(spark):
    return K.accumulate(K.classify_rows(spark.createDataFrame(ROWS, CONTRACT_RAW)))


def test_reasons(spark):
    rows = K.classify_rows(spark.createDataFrame(ROWS, CONTRACT_RAW)).collect()
    assert [r["reason"] for r in rows] == [K.KEPT] * 5 + [K.SUMMARY] * 2 + [K.MISSING_KEY] * 2 + [K.NO_YEAR, K.NEGATIVE]


def test_groups(grouped):
    got = {tuple(r)[:4]: tuple(r)[4:] for r in K.subject_year(grouped).collect()}
    assert got == {
        ("A", "1", "Maths", 2020): (1500.5, 15, 1500.5 / 15, "OK"),
        ("A", "2", "Art", 2021): (0.0, 0, 0.0, "No activity"),
        ("B", "1", "Maths", 2020): (70.0, 0, None, "Undefined (0 students)"),
    }
    assert K.school_year(grouped).count() == 3


def test_counters(grouped):
    got = {r["metric"]: r["value"] for r in K.quality_counters(grouped).collect()}
    assert got == {
        "rows_seen": 11, "dropped_missing_keys": 2, "dropped_missing_year": 1, "dropped_summary_rows": 2,
        "missing_cost": 2, "missing_students": 1, "negative_students": 1, "subject_year_groups": 3,
        "school_year_groups": 3, "undefined_groups": 1, "no_activity_groups": 1,
    }


def test_empty_input_keeps_schemas(spark):
    grouped = K.accumulate(K.classify_rows(spark.createDataFrame([], CONTRACT_RAW)))
    schools = K.school_year(grouped)
    assert schools.columns == ["school", "year", "total_oncosts", "total_students", "oncosts_per_student", "status"]
    assert S.trend_matrix(schools).collect() == []
    assert S.subject_report(K.subject_year(grouped)).collect() == []
    bands = B.fuzzy_bands(schools, B.year_anchors(schools))
    assert bands.collect() == [] and B.band_summary(bands).columns == ["year", "low", "medium", "high", "total"]
    assert {r["metric"]: r["value"] for r in K.quality_counters(grouped).collect()}["rows_seen"] == 0


def _schools(spark, values):
    return spark.createDataFrame(
        [(f"s{i}", y, x) for i, (y, x) in enumerate(values)], "school string, year int, oncosts_per_student double"
    )


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 999, 1000, 30_001])
def test_median_is_exact(spark, n):
    rng = random.Random(n)
    values = [(2000, rng.uniform(1, 1e6)) for _ in range(n)]
    row = B.year_anchors(_schools(spark, values).repartition(4)).first()
    xs = [x for _, x in values]
    assert tuple(row) == (2000, min(xs), statistics.median(xs), max(xs))


def test_median_with_a_third_equal(spark):
    rng = random.Random(1)
    values = [(2000, 7.0)] * 7000 + [(2000, rng.uniform(1, 20)) for _ in range(14_000)] + [(2001, None), (2001, 0.0)]
    values += [(2002, 3.0)] * 5000 + [(2002, 4.0)] * 5000
    got = {r["year"]: tuple(r)[1:] for r in B.year_anchors(_schools(spark, values).repartition(4)).collect()}
    xs = [x for y, x in values if y == 2000]
    assert got[2000] == (min(xs), statistics.median(xs), max(xs))
    assert got[2001] == (None, None, None)
    assert got[2002] == (3.0, 3.5, 4.0)


@pytest.mark.parametrize("parts", [64, B.CLASS_PARTS])
def test_median_of_any_distribution(spark, monkeypatch, parts):
    """Costs of all sizes, doubles next to each other, the least and the greatest double, and nearly all equal."""
    monkeypatch.setattr(B, "CLASS_PARTS", parts)
    rng = random.Random(parts)
    near = [1000.0]
    for _ in range(200):
        near.append(math.nextafter(near[-1], math.inf))
    years = {
        2000: [10.0 ** rng.uniform(-250, 250) for _ in range(2001)],
        2001: near,
        2002: [5e-324, 1e-323, 1.5e-323, sys.float_info.max],
        2003: [7.25] * 3000 + [math.nextafter(7.25, 8)] * 3000,
        2004: [1.0] * 999 + [1e300] * 1000,
        2005: [rng.choice([2.5, 2.5, 3.5, 1e9, rng.random()]) for _ in range(1500)],
    }
    schools = _schools(spark, [(y, x) for y, xs in years.items() for x in xs]).repartition(4)
    got = {r["year"]: tuple(r)[1:] for r in B.year_anchors(schools).collect()}
    assert got == {y: (min(xs), statistics.median(xs), max(xs)) for y, xs in years.items()}
    exact = schools.groupBy("year").agg(F.expr("percentile(oncosts_per_student, 0.5)").alias("p"))
    for year, p in exact.collect():
        assert got[year][1] == pytest.approx(p, rel=1e-15)


def test_bands_and_totals_agree(spark):
    rng = random.Random(4)
    schools = _schools(spark, [(2000 + i % 3, rng.uniform(0, 10)) for i in range(300)])
    bands = B.fuzzy_bands(schools, B.year_anchors(schools))
    summary = B.band_summary(bands)
    assert summary.agg(F.sum("total")).first()[0] == bands.count() == 300
    assert summary.where(F.col("low") + F.col("medium") + F.col("high") != F.col("total")).count() == 0


def test_wide_shapes(grouped):
    matrix = S.trend_matrix(K.school_year(grouped))
    assert matrix.columns == ["school", "2020", "2021"]
    assert sorted(map(tuple, matrix.collect())) == [("A", 1500.5 / 15, 0.0), ("B", None, None)]
    report = S.subject_report(K.subject_year(grouped))
    assert report.columns[3:] == [
        "2020 Incl Oncosts", "2021 Incl Oncosts", "2020 Incl Oncosts Per Student", "2021 Incl Oncosts Per Student",
        "2020 Student Count", "2021 Student Count",
    ]
    assert tuple(report.where("subject = 'Art'").first())[3:] == (0.0, 0.0, None, 0.0, 0, 0)
    assert S.long_report(K.subject_year(grouped)).count() == 3
