"""What the physical plans must and must not contain."""

import re

import pytest

from costledger.plans.queries import QUERIES

# queries that end in one row, or number a small table
ONE_TASK = {
    "quality_counters", "processing_summary", "scorecard", "verdict", "own_statements_verdict", "batch_totals",
    "dry_run_batches", "pii_dictionary", "pii_dictionary_people", "redacted_reference", "located_header",
}
# tasks that read byte ranges of files
FILE_BLOCKS = {"fingerprint", "file_digests", "quoted_records"}
PYTHON = {"redacted_documents", "redacted_by_join", "redacted_phrases", "redacted_conversations", "redacted_reference"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark, sf):
    return {name: plan_of(query(spark, sf)) for name, query in QUERIES.items()}


def test_no_cross_joins(plans):
    assert [n for n, p in plans.items() if "NestedLoop" in p or "CartesianProduct" in p] == []


def test_no_rows_through_one_task(plans):
    assert {n for n, p in plans.items() if "SinglePartition" in p} <= ONE_TASK


def test_python_in_redaction_and_blocks_of_files_only(plans):
    assert {n for n, p in plans.items() if re.search("Python|Pandas|Arrow", p)} == PYTHON | FILE_BLOCKS


def test_first_rows_are_cut_before_the_shuffle(plans):
    for name in ("bad_row_sample", "data_issues", "first_messages"):
        assert plans[name].count("WindowGroupLimit") >= 2


def test_scans_read_needed_columns_only(plans):
    columns = re.search(r"FileScan parquet \[([^\]]*)\]", plans["monthly_trends"]).group(1)
    assert "o_orderpriority" not in columns and "o_orderdate" in columns


def test_spenders_aggregate_before_the_join(plans):
    plan = plans["spenders"]
    assert re.search(r"Join.*\n(.*\n)*?.*HashAggregate\(keys=\[tr_code", plan)


def test_band_anchors_are_broadcast(plans):
    assert "BroadcastHashJoin [year" in plans["fuzzy_bands"]
