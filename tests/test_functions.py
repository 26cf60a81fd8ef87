import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from costledger.functions import cost as C
from costledger.functions import numbers as N
from costledger.functions import text as X


def test_ustrip_equals_python(column):
    samples = ["  a b 　", "\x1c\x1fx ", "", "​ keeps zero width", " a ", None]
    assert column(samples, X.ustrip("c")) == [s if s is None else s.strip() for s in samples]


def test_headers(column):
    got = column([" Subject   NO. ", "School", "INCL.\tOncosts", "Remarks ", None, ""], X.canonical_header("c"))
    assert got == ["subject_no", "school", "incl_oncosts", "Remarks", "", ""]
    assert column([" A   b\n"], X.normalise_header("c")) == ["a b"]


def test_summary_words(column):
    got = column([" TOTAL", "sum ", "Result", "totals", "", None], X.is_summary_word("c"))
    assert got == [True, True, True, False, False, False]


def test_year(column):
    got = column(["Autumn 120199", "S1 2021/2022", "TBA", None, "1899", "x2099y"], X.extract_year("c"))
    assert got == [2019, 2021, None, None, None, 2099]


def _python_float(text, ignored):
    if text is None:
        return None
    for ch in ignored:
        text = text.replace(ch, "")
    try:
        value = float(text)
    except ValueError:
        return None
    return value if math.isfinite(value) else None


MONEY = [
    "$1,234.50", "-5", "1_000", "(12)", "nan", "inf", "12d", " ", "", None, "$ 12", "1e5", "1e400", "+.5", "5.", ".",
    "-", "1__0", "_1", "1_", "0x10", "1e", "1 2", " 12 ", "--1", "1.2.3", "-0.0", "Infinity", "1E-3", "12f", "9" * 400,
]


def test_money(column):
    assert column(MONEY, N.money("c")) == [_python_float(s, "$,") for s in MONEY]


def test_random_numbers_equal_python(column):
    rng = random.Random(5)
    samples = ["".join(rng.choice("01259.,$eE+-_ df") for _ in range(rng.randint(0, 7))) for _ in range(4000)]
    assert column(samples, N.money("c")) == [_python_float(s, "$,") for s in samples]


def test_head_count(column):
    samples = ["12.7", "-0.5", "1,200", "$5", "inf", "-3", None, "", "x", "-3.9", "1e3"]
    assert column(samples, N.head_count("c")) == [12, 0, 1200, None, None, -3, None, None, None, -3, 1000]


def test_loose_number(column):
    samples = ["1,234", "$5", " 12 ", "1e3", None, "", "nan", "inf", "-Infinity", "12d", "1_000", "-7.25"]
    got = column(samples, N.loose_number("c"))
    assert got == [0.0, 0.0, 12.0, 1000.0, 0.0, 0.0, 0.0, math.inf, -math.inf, 0.0, 0.0, -7.25]


def test_whole_year(column):
    assert column(["2023", "2023.0", " 2023 ", "2023.5", "FY", None], N.whole_year("c")) == [2023, 2023, 2023, None, None, None]


def test_tr_code(column):
    samples = ["0012345 - Foo", "00012345678", "123456 x", " 1234567", None, "", " 1234567", "12345678"]
    got = column(samples, X.extract_tr_code("c"))
    assert got == ["0012345", "1234567", None, "1234567", None, None, "1234567", "1234567"]


def test_zero_pad_equals_zfill(column):
    samples = ["12", "-12", "+1", "123456789", "", "-", "1234567", "-123456"]
    assert column(samples, X.zero_pad("c")) == [s.zfill(7) for s in samples]


def test_email_tokens(column):
    got = column(["jo.van-dyke_x@y", "plain", None, "abc@d@e", "Ab.CDE@x"], X.email_tokens("c"))
    assert got == [["van", "dyke"], [], [], ["abc"], ["CDE"]]


def test_safe_name(spark):
    df = spark.createDataFrame([(" Ann ", None), ("Bo", "Lee ")], "a string, b string")
    assert [r[0] for r in df.select(X.safe_name("a", "b")).collect()] == ["Ann_None", "Bo_Lee"]


def test_is_tr_code(column):
    assert column(["1234567", "123456", "12345678", "1234567\n", None], X.is_tr_code("c")) == [True, False, False, False, False]


def test_decimals(column):
    got = column(["1,234.5", "x", "", None, "1e3", "1-2", "inf"], F.coalesce(N.exact_number(N.number_text("c"))["d"].cast("string"), N.exact_number(N.number_text("c"))["t"]))
    assert [None if v is None else float(v) for v in got] == [1234.5, None, None, None, 1000.0, None, None]
    got = column(["1,234.5", "x", "", None, " 2 "], N.lenient_decimal("c"))
    assert [None if v is None else float(v) for v in got] == [None, None, 0.0, 0.0, 2.0]


def test_exact_numbers_compare_as_python_decimals(spark):
    texts = [
        "0", "-0.0", "1", "1.0", "-1", "1.00000000001", "1.00000000002", "-1.00000000001", "1e29", "1.5e29", "-1e29", "0.1", "0.01", "-0.1", "-0.01",
        "99999999999999999999999999999999999999999.5", "1e-40", "-1e-40", "12", "1.2", "1.25", "-1.2", "-1.25", "2020.00000000001", "1e400", "100",
    ]
    left = spark.createDataFrame([(t,) for t in texts], "a string").withColumn("x", N.exact_number(N.number_text("a")))
    right = left.toDF("b", "y")
    got = left.join(right, F.lit(True)).select("a", "b", N.exceeds(F.col("x"), F.col("y")).alias("more")).collect()
    assert all(r["more"] == (Decimal(r["a"]) > Decimal(r["b"])) for r in got) and len(got) == len(texts) ** 2
    whole = {r["a"]: r["w"] for r in left.select("a", N.is_whole_number(F.col("x")).alias("w")).collect()}
    assert whole == {t: Decimal(t) == Decimal(t).to_integral_value() for t in texts}


def test_counts_beyond_64_bits(column):
    got = column(["9e18", "1e19", "-2.9", "1,234.7", "x", None, "0"], N.head_count("c"))
    assert got == [9 * 10**18, 10**19, -2, 1234, None, None, 0]


def test_rounding_equals_python(spark):
    rng = random.Random(2)
    values = [0.00015, 2.675, 0.125, 0.5, 1.00005, -0.00015, 0.0, 1e15] + [rng.uniform(-10, 1e6) for _ in range(500)]
    values += [rng.randint(0, 10**6) / 64 for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = df.select("x", N.round_exact("x", 4).alias("r"), N.fixed_text("x", 2).alias("t")).collect()
    assert all(r["r"] == round(r["x"], 4) and r["t"] == f"{r['x']:.2f}" for r in rows)


def test_money_text(spark):
    values = [1234567.891, 0.125, -5.0, 2.675]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(F.format_number("x", 2)).collect()] == [f"{v:,.2f}" for v in values]


def _total(df):
    return df.agg(*N.sum_parts("x", "x")).select(N.parts_total("x")).first()[0]


def test_sums_are_exact_in_any_order(spark):
    rng = random.Random(9)
    values = [round(rng.uniform(-1e6, 1e6), rng.randint(0, 4)) for _ in range(500)]  # units
    values += [round(rng.uniform(-1, 1), 9) for _ in range(200)]  # more decimals
    values += [rng.randint(10**8, 10**12) / 100 * rng.choice((-1, 1)) for _ in range(200)]  # large
    want = float(sum(Decimal(repr(v)) for v in values))
    for seed in range(3):
        random.Random(seed).shuffle(values)
        df = spark.createDataFrame([(v,) for v in [*values, None]], "x double").repartition(4)
        assert _total(df) == want


def test_sums_of_extremes(spark):
    assert _total(spark.createDataFrame([(1e20,), (0.1,), (-3.0,)], "x double")) == 1e20
    assert _total(spark.createDataFrame([(float("inf"),), (1.0,)], "x double")) == math.inf
    assert math.isnan(_total(spark.createDataFrame([(float("nan"),), (1.0,)], "x double")))
    assert _total(spark.createDataFrame([(None,)], "x double")) == 0.0
    assert _total(spark.createDataFrame([(99_999_999.9999,)] * 3, "x double")) == 299_999_999.9997
    assert _total(spark.createDataFrame([(-0.0001,)] * 3, "x double")) == -0.0003


def test_sums_merge(spark):
    df = spark.createDataFrame([(i % 3, i * 0.01 + (1e-7 if i % 50 == 0 else 0)) for i in range(1000)], "g int, x double")
    fine = df.groupBy("g").agg(*N.sum_parts("x", "x"))
    assert fine.agg(*N.merge_parts("x")).select(N.parts_total("x")).first()[0] == _total(df)


@pytest.mark.parametrize(
    ("cost", "students", "want"),
    [
        (10.0, 4, (2.5, "OK")),
        (0.0, 0, (0.0, "No activity")),
        (5.0, 0, (None, "Undefined (0 students)")),
        (-5.0, 0, (None, "Undefined (0 students)")),
    ],
)
def test_cost_per_student(spark, cost, students, want):
    df = spark.createDataFrame([(cost, students)], "c double, s bigint")
    row = df.select(C.cost_per_student(F.col("c"), F.col("s")), C.cost_status(F.col("c"), F.col("s"))).first()
    assert tuple(row) == want


@pytest.mark.parametrize(
    ("x", "anchors", "want"),
    [
        (1.0, (1, 2, 4), (1.0, 0.0, 0.0, "Low")),
        (2.0, (1, 2, 4), (0.0, 1.0, 0.0, "Medium")),
        (4.0, (1, 2, 4), (0.0, 0.0, 1.0, "High")),
        (1.5, (1, 2, 4), (0.5, 0.5, 0.0, "Medium")),
        (3.0, (1, 2, 4), (0.0, 0.5, 0.5, "Medium")),
        (3.0, (3, 3, 3), (1.0, 1.0, 1.0, "Medium")),
        (1.0, (1, 1, 4), (1.0, 1.0, 0.0, "Medium")),
        (2.5, (1, 1, 4), (0.0, 0.0, 0.5, "High")),
    ],
)
def test_memberships(spark, x, anchors, want):
    df = spark.createDataFrame([(x, *map(float, anchors))], "x double, a double, b double, c double")
    x, a, b, c = (F.col(n) for n in "xabc")
    low, mid, high = C.membership_low(x, a, b), C.membership_medium(x, a, b, c), C.membership_high(x, b, c)
    assert tuple(df.select(low, mid, high, C.band(low, mid, high)).first()) == want


def test_usable(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 0.0, -1.0, float("inf"), float("nan"), None)], "x double")
    assert [bool(r[0]) for r in df.select(C.is_usable(F.col("x"))).collect()] == [True] + [False] * 5
