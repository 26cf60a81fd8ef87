import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from costledger.operators import reconcile as R
from costledger.schemas import REFERENCE, TRANSACTION


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(8)
    # one code holds a third of all rows
    tx = []
    for i in range(3000):
        code = "0000001" if i % 3 == 0 else f"{rng.randint(1, 60):07d}"
        tx.append((code, code + " x", rng.randint(0, 10**6) / 100, 1.0, rng.randint(-(10**6), 10**6) / 100, 2020, str(i % 12), "d", i // 100, i))
    ref = [
        (f"{c:07d}", None if c % 13 == 0 else str(c // 2), f"N{c}", None if c % 7 == 0 else f"F{c // 2}", f"m{c}@x")
        for c in range(0, 50)
    ]
    return spark.createDataFrame(tx, TRANSACTION).repartition(4), spark.createDataFrame(ref, REFERENCE), tx, ref


def _joined(tx, ref):
    staff = {r[0]: r for r in ref}
    return [(t, staff[t[0]]) for t in tx if t[0] in staff]


def test_ledger(data):
    tx, ref, raw, people = data
    want = [(t, r) for t, r in _joined(raw, people) if None not in r]
    rows = R.ledger(tx, ref).collect()
    assert Counter((r["batch_id"], r["tr_code"], r["net_amount"], r["email"]) for r in rows) == Counter(
        (t[8], t[0], t[4], r[4]) for t, r in want
    )


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_ledger_does_not_depend_on_the_join(spark, data, threshold):
    tx, ref, raw, people = data
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", threshold)
    try:
        assert R.ledger(tx, ref).count() == sum(None not in r for _, r in _joined(raw, people))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_hot_code_is_split(spark, data):
    """Without a broadcast, the partition of the code with a third of the rows is joined in several tasks."""
    tx, ref, raw, people = data
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "20",
    }
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        ledger = R.ledger(tx, ref)
        assert len(ledger.collect()) == sum(None not in r for _, r in _joined(raw, people))
        assert "skew=true" in ledger._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_spenders(data):
    tx, ref, raw, people = data
    sums = defaultdict(lambda: [0, 0, 0, 0])
    for t, r in _joined(raw, people):
        s = sums[r[1:]]
        for i, v in enumerate((1, *t[2:5])):
            s[i] += round(v * 100)
    got = {tuple(r)[:4]: [r["txn_count"] * 100] + [round(v * 100) for v in tuple(r)[5:]] for r in R.spenders(tx, ref).collect()}
    assert got == dict(sums)


def test_staff_totals_and_first_row(data):
    tx, ref, raw, people = data
    first, count = {}, Counter()
    for t, r in _joined(raw, people):
        if r[1] is not None:
            count[r[1]] += 1
            first.setdefault(r[1], (r[2], r[3], r[4]))
    rows = R.staff_totals(tx, ref).collect()
    assert {r["staff_id"]: (r["first_name"], r["family_name"], r["email"]) for r in rows} == first
    assert {r["staff_id"]: r["txn_count"] for r in rows} == dict(count)


def test_statements_close_with_their_total(data):
    tx, ref, raw, people = data
    rows = R.statements(tx, ref)
    sums = rows.groupBy("staff_id").agg(
        F.round(F.sum(F.when(~F.col("is_total"), F.col("net_amount"))), 2).alias("detail"),
        F.sum(F.when(F.col("is_total"), F.col("net_amount"))).alias("total"),
        F.count_if("is_total").alias("n"),
    )
    assert sums.where("n <> 1 or abs(detail - total) > 0.005").count() == 0
    total = rows.where("is_total").first()
    assert total["description"] == "TOTAL" and total["tr_code"] is None and total["email"] is None


def test_one_statement_and_active_staff(data):
    tx, ref, raw, people = data
    joined = _joined(raw, people)
    assert R.staff_statement(tx, ref, "3").count() == sum(r[1] == "3" for _, r in joined)
    assert {r[0] for r in R.active_staff(tx, ref).collect()} == {r[1] for _, r in joined}


def test_summaries_count_unmatched_rows(data):
    tx, _, raw, _ = data
    assert R.monthly_trends(tx).agg(F.sum("txn_count")).first()[0] == len(raw)
    assert R.account_summary(tx).agg(F.sum("txn_count")).first()[0] == len(raw)


def test_message(spark):
    totals = spark.createDataFrame(
        [("7", " Ann ", None, None, 2, 1234567.891, 0.125, -5.0)],
        "staff_id string, first_name string, family_name string, email string, txn_count bigint, total_debit double, "
        "total_credit double, total_net_spend double",
    )
    row = R.messages(totals, R.Letter(title="Fund", signature="100% Team")).first()
    assert (row["subject"], row["recipient"], row["attachment_name"]) == ("Fund - Ann_None", "None", "Fund_Ann_None_7")
    assert "Hi Ann,\n\nAttached is a summary of your 2 transaction(s)." in row["body"]
    assert "Debit: $1,234,567.89\nCredit: $0.12\nNet Amount: $-5.00\n" in row["body"]
    assert row["body"].endswith("Kind regards,\n100% Team\n")
