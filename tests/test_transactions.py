import pytest

from costledger.operators import transactions as TX
from costledger.operators.reference import check_reference, prepare_reference, reference_issues
from costledger.schemas import TRANSACTION


def _raw(spark, n=40, bad=lambda i: i % 4 == 0):
    rows = [(i, "Unallocated" if bad(i) else f"00{12345 + i} - x", "1", "x", None, "2020.0" if i % 2 else "FY", str(i % 12), "d") for i in range(n)]
    return spark.createDataFrame(
        rows, "src_row bigint, `Activity Level 3 Code and Name` string, debit string, credit string, net_amount string, "
        "Year string, Month string, journal_line_desc string",
    )


def test_clean(spark):
    classified = TX.classify_transactions(_raw(spark), 10)
    rows = TX.valid_transactions(classified).orderBy("src_row").collect()
    assert len(rows) == 30 and list(rows[0].asDict()) == TRANSACTION.names
    first = rows[0].asDict()
    assert first == {
        "tr_code": "0012346", "account_name": "0012346 - x", "debit": 1.0, "credit": 0.0, "net_amount": 0.0, "year": 2020,
        "month": "1", "description": "d", "batch_id": 0, "src_row": 1,
    }
    assert rows[-1]["batch_id"] == 3


def test_missing_columns(spark):
    df = _raw(spark).drop("debit", "Month")
    row = TX.classify_transactions(df, 10).where("src_row = 1").first()
    assert row["debit"] == 0.0 and row["month"] is None
    with pytest.raises(ValueError, match="activity"):
        TX.classify_transactions(_raw(spark).drop("Activity Level 3 Code and Name"))


def test_issues_keep_the_first_of_each_batch(spark):
    classified = TX.classify_transactions(_raw(spark, 60, bad=lambda i: i % 30 < 9), 30)
    rows = TX.bad_row_sample(classified).orderBy("row_idx").collect()
    assert [r["row_idx"] for r in rows] == [0, 1, 2, 3, 4, 30, 31, 32, 33, 34]
    years = TX.data_issues(classified).where("column = 'Year'").orderBy("row_idx").collect()
    assert [r["row_idx"] for r in years] == [0, 2, 4, 6, 8, 30, 32, 34, 36, 38]


def test_scorecard(spark):
    classified = TX.classify_transactions(_raw(spark), 10)
    assert tuple(TX.scorecard(classified).first()) == (40, 30, 75.0)
    assert tuple(TX.scorecard(classified.where("false")).first()) == (0, 0, 0.0)


@pytest.mark.parametrize("limit", [0, 1, 7, 8, 15, 16, 100])
def test_dry_run_keeps_whole_batches(spark, limit):
    classified = TX.classify_transactions(_raw(spark), 10)
    valid = {b: sum(1 for i in range(10 * b, 10 * b + 10) if i % 4) for b in range(4)}
    want, total = set(), 0
    for b in range(4):
        if limit and total >= limit:
            break
        want.add(b)
        total += valid[b]
    got = {r["batch_id"] for r in TX.limit_batches(classified, limit).select("batch_id").distinct().collect()}
    assert got == want


def test_dry_run_counting_all_rows(spark):
    classified = TX.classify_transactions(_raw(spark), 10)
    assert TX.limit_batches(classified, 10, count_all=True).count() == 10
    assert TX.limit_batches(classified, 11, count_all=True).count() == 20


def _reference(spark, codes):
    rows = [(c, f" {i} ", "F", None) for i, c in enumerate(codes)]
    return spark.createDataFrame(rows, "`TR Code` string, Staff_ID string, First_Name string, Extra string")


def test_reference(spark):
    rows = prepare_reference(_reference(spark, [" 12 ", "-12", "123456789"])).collect()
    assert [tuple(r) for r in rows] == [
        ("0000012", "0", "F", None, None), ("-000012", "1", "F", None, None), ("123456789", "2", "F", None, None),
    ]
    renamed = _reference(spark, ["1"]).withColumnRenamed("Extra", "Work_Email").selectExpr("*", "'a@b' as mail")
    assert prepare_reference(renamed, {"mail": "email"}).first()["email"] == "a@b"


@pytest.mark.parametrize(
    ("codes", "message"),
    [(["1", None, ""], "missing"), (["1", " "], "empty"), (["1", "NaN"], "empty"), (["1", "0000001"], "duplicate")],
)
def test_reference_errors(spark, codes, message):
    with pytest.raises(ValueError, match=message):
        check_reference(_reference(spark, codes))


def test_good_reference_passes(spark):
    check_reference(_reference(spark, ["1", "2", "0000000"]))
    assert reference_issues(_reference(spark, ["1", "2"])).count() == 0
    with pytest.raises(ValueError, match="TR_Code column"):
        prepare_reference(_reference(spark, ["1"]).drop("TR Code"))
