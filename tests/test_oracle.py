import compare
import pytest

import __spark_entry__ as entry
from costledger.plans.oracle import ORACLE
from costledger.plans.queries import QUERIES

WITHOUT_SQL = {"redacted_conversations", "own_statements_verdict", "fingerprint"}


@pytest.fixture(scope="module")
def con(sf):
    return compare.connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf, con, name):
    assert compare.differences(QUERIES[name](spark, sf), con, ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_query_without_sql_has_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_every_query_is_checked():
    assert set(QUERIES) - set(ORACLE) == WITHOUT_SQL


def test_own_statements_pass(spark, sf):
    assert QUERIES["own_statements_verdict"](spark, sf).first()["verdict"] == "PASS"


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "band" in df.columns
