import random
from decimal import Decimal, localcontext

import pytest

from costledger.operators import validate as V
from costledger.schemas import VIOLATION


def _messages(df):
    return sorted((r["message"] for r in df.collect()))


def _amounts(spark, values, key="f"):
    return spark.createDataFrame([(key, i, v) for i, v in enumerate(values, 2)], "file_key string, row_num bigint, total_net_spend string")


def test_amount_order(spark):
    assert _messages(V.amount_order_violations(_amounts(spark, ["5", "3", "4"]))) == ["f: Total_Net_Spend not sorted DESC at row 4"]
    assert _messages(V.amount_order_violations(_amounts(spark, ["5", "5", "1,000", "x"]))) == [
        "f: Total_Net_Spend not sorted DESC at row 4"
    ]
    assert _messages(V.amount_order_violations(_amounts(spark, ["5", None, "x", " ", "4"]))) == [
        "f: invalid Total_Net_Spend at row 4: 'x'", "f: missing Total_Net_Spend at row 3", "f: missing Total_Net_Spend at row 5",
    ]


def test_files_are_independent(spark):
    rows = _amounts(spark, ["1"]).unionByName(_amounts(spark, ["0", "9", "x"], "g"))
    assert _messages(V.amount_order_violations(rows)) == ["g: Total_Net_Spend not sorted DESC at row 3"]


def _months(spark, values):
    rows = [("f", i, y, m) for i, (y, m) in enumerate(values, 2)]
    return V.month_order_violations(spark.createDataFrame(rows, "file_key string, row_num bigint, year string, month string"))


def test_month_order_is_text(spark):
    assert _messages(_months(spark, [("2020", "9"), ("2020", "12"), ("2019", "9")])) == []
    assert _messages(_months(spark, [("2020", "12"), ("2020.0", "9")])) == ["f: Month not sorted DESC at row 3"]
    assert _messages(_months(spark, [("2020", "1"), ("2021", "1"), ("x", "1")])) == ["f: Year not sorted DESC at row 3"]
    assert _messages(_months(spark, [("2020", "1"), ("2020.5", "1"), (None, "1"), ("q", "1"), ("2020", " ")])) == [
        "f: Year not an integer at row 3", "f: invalid Year at row 5: 'q'", "f: missing Month at row 6", "f: missing Year at row 4",
    ]


def test_codes(spark):
    rows = spark.createDataFrame([("f", 2, " 1234567 "), ("f", 3, "12"), ("f", 4, None)], "file_key string, row_num bigint, tr_code string")
    assert _messages(V.code_violations(rows)) == ["f: invalid TR_Code at row 3: '12'", "f: invalid TR_Code at row 4: ''"]


def _statement(spark, rows):
    df = spark.createDataFrame(
        [("s", i, *r) for i, r in enumerate(rows, 2)],
        "file_key string, row_num bigint, description string, debit string, credit string, net_amount string",
    )
    return _messages(V.total_violations(df))


@pytest.mark.parametrize(("net", "bad"), [("3.01", False), ("3.02", True), ("2.98", True)])
def test_totals(spark, net, bad):
    rows = [("a", "1", None, "1"), ("b", "2", "", "2"), (None, None, None, None), (" TOTAL", "3", "0", net)]
    assert _statement(spark, rows) == (["s: TOTAL Net_Amount does not match recomputed sum"] if bad else [])


@pytest.mark.parametrize(
    ("debits", "total", "bad"),
    [
        (["9" * 40 + ".25", "-" + "9" * 40 + ".20"], "0.05", False),
        (["9" * 40 + ".25", "-" + "9" * 40 + ".20"], "0.07", True),
        (["1e400", "1", "-1E+400"], "1.01", False),
        (["1e400", "1", "-1E+400"], "1.02", True),
        (["1e400", "1"], "1" + "0" * 399 + "1", False),
        (["1e400", "1"], "1e400", True),
        (["0.1", "0." + "0" * 60 + "1"], "0.11", False),
        (["0.1", "-0." + "0" * 60 + "1"], "0.11", True),
        (["5", "1e99999999999999999999"], "5", "invalid"),
    ],
)
def test_totals_of_any_length(spark, debits, total, bad):
    rows = [("a", d, "1e0", "000000000000000000000001.50") for d in debits]
    found = _statement(spark, [*rows, ("TOTAL", total, str(len(debits)), str(1.5 * len(debits)))])
    if bad == "invalid":
        assert found == ["s: invalid Debit at row 3"]
    else:
        assert found == (["s: TOTAL Debit does not match recomputed sum"] if bad else [])


def test_long_totals_against_decimals(spark):
    """Random amounts of up to 80 digits with cancelling parts, against arithmetic that rounds nothing."""
    rng = random.Random(8)

    def amount():
        digits = "".join(rng.choice("0019") for _ in range(rng.choice([1, 9, 18, 27, 80])))
        text = rng.choice(["", "-"]) + digits + rng.choice(["", ".5", "." + digits, f"e{rng.randint(-40, 40)}"])
        return text

    rows, want = [], set()
    with localcontext(prec=400):
        for i in range(300):
            own = [amount() for _ in range(rng.randint(0, 6))]
            own += [a[1:] if a.startswith("-") else "-" + a for a in own if rng.random() < 0.7]
            total = sum((Decimal(a) for a in own), Decimal(0))
            shown = total + rng.choice([Decimal(0), Decimal("0.01"), Decimal("-0.01"), Decimal("0.0100000000000000000001"), Decimal("-1e-1")])
            if abs(total - shown) > Decimal("0.01"):
                want.add(f"s{i}")
            rows += [(f"s{i}", n, "a", a, None, None) for n, a in enumerate(own)]
            rows.append((f"s{i}", len(own), "TOTAL", str(shown), None, ""))
    df = spark.createDataFrame(rows, "file_key string, row_num bigint, description string, debit string, credit string, net_amount string")
    got = V.total_violations(df.repartition(4)).collect()
    assert {r["file_key"] for r in got} == want and {r["rule"] for r in got} == {"total differs"}


def test_total_rows(spark):
    assert _statement(spark, [("a", "1", "1", "1")]) == ["s: TOTAL row not found"]
    assert _statement(spark, [("a", "1", "1", "1"), ("TOTAL", "9", "9", "9"), ("TOTAL", "1", "1", "1")]) == ["s: multiple TOTAL rows found"]
    assert _statement(spark, [("a", "x", "1", "1"), ("TOTAL", "0", "1", "z")]) == [
        "s: TOTAL Net_Amount does not match recomputed sum", "s: invalid Debit at row 2", "s: invalid Net_Amount at row 0",
    ]


def test_each_repeated_total_is_reported(spark, monkeypatch):
    monkeypatch.setattr(V, "BLOCK", 4)
    for n in (2, 5, 6, 9, 14):
        assert _statement(spark, [("TOTAL", "0", "0", "0")] * n) == ["s: multiple TOTAL rows found"] * (n - 1)


def test_messages_are_limited_and_all_counted(spark):
    found = V.amount_order_violations(_amounts(spark, ["x"] * 9))
    assert _messages(V.first_messages(found)) == [f"f: invalid Total_Net_Spend at row {i}: 'x'" for i in range(2, 7)]
    assert tuple(V.error_counts(found).first()) == ("f", 9)
    assert tuple(V.verdict(found).first()) == ("FAIL", 9, 1)
    assert tuple(V.verdict(V.no_violations(spark)).first()) == ("PASS", 0, 0)


def test_messages_follow_the_checks(spark):
    rows = [("f", None, "total differs", "d"), ("f", 3, "tr_code", "b"), ("f", 3, "not sorted", "c"), ("f", None, "columns", "a")]
    found = spark.createDataFrame(rows, VIOLATION)
    assert _messages(V.first_messages(found, 2)) == ["a", "b"]
    assert _messages(V.first_messages(found, 3)) == ["a", "b", "c"]


def test_header_case_does_not_matter(spark):
    rows = spark.createDataFrame([("f", 2, "12")], "file_key string, row_num bigint, TR_Code string")
    assert _messages(V.code_violations(rows)) == ["f: invalid TR_Code at row 2: '12'"]


def test_package(spark):
    assert sorted(r["rule"] for r in V.package_violations(spark, {}).collect()) == ["missing table"] * 4 + ["no package"]
    tables = {
        "All_Spenders": spark.createDataFrame([(2, "x")], "row_num bigint, other string"),
        "Transaction_Ledger": spark.createDataFrame([(2, "12")], "row_num bigint, tr_code string"),
        "Monthly_Trends": spark.createDataFrame([(2, "2020", "1")], "row_num bigint, year string, month string"),
        "Extra": spark.createDataFrame([(2,)], "row_num bigint"),
        "Statements": spark.createDataFrame([("s", 2, "1")], "file_key string, row_num bigint, debit string"),
    }
    assert _messages(V.package_violations(spark, tables)) == [
        "All_Spenders: missing Total_Net_Spend column",
        "Extra: missing header row",
        "Statements: missing Description or Credit or Net_Amount column",
        "Transaction_Ledger: invalid TR_Code at row 2: '12'",
        "package: missing Spending_by_Account",
    ]


def test_all_missing(spark):
    from costledger.functions.text import all_missing

    df = spark.createDataFrame([(None, None), (1, None)], "a int, `b c` string")
    assert [r[0] for r in df.select(all_missing(df.columns)).collect()] == [True, False]
