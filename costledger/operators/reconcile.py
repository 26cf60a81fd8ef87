"""Transactions against the staff reference: ledger, summaries, statements and messages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costledger.functions import numbers as N
from costledger.functions import text as X
from costledger.schemas import LEDGER_COLUMNS, STATEMENT_COLUMNS

AMOUNTS = ("debit", "credit", "net_amount")
STAFF = ["staff_id", "first_name", "family_name", "email"]


def _totals() -> list:
    return [
        N.parts_total("debit").alias("total_debit"),
        N.parts_total("credit").alias("total_credit"),
        N.parts_total("net_amount").alias("total_net_spend"),
    ]


def joined(transactions: DataFrame, reference: DataFrame) -> DataFrame:
    """Transactions with their staff; those without a reference row disappear.

    Left to Spark: it broadcasts a reference that is measured to be small, else it shuffles both sides, and
    then splits a code that holds many transactions over several tasks (skew join), as the result is not grouped.
    """
    return transactions.join(reference, "tr_code")


def ledger(transactions: DataFrame, reference: DataFrame) -> DataFrame:
    """The joined rows with complete staff data, in the ledger's columns."""
    return joined(transactions, reference.dropna(subset=STAFF)).select(*LEDGER_COLUMNS)


def code_totals(transactions: DataFrame) -> DataFrame:
    """Sums, count and first source row per code, before any join.

    Staff figures are built on this table: the join then sees a row per code, so a code or a member of staff
    with a large share of all transactions costs no more than any other.
    """
    return transactions.groupBy("tr_code").agg(
        F.count("net_amount").alias("txn_count"),
        *[part for name in AMOUNTS for part in N.sum_parts(name, name)],
        F.min("src_row").alias("first_row"),
    )


def spenders(transactions: DataFrame, reference: DataFrame) -> DataFrame:
    """Count and sums by staff id, names and email; NULLs among them form groups."""
    return (
        code_totals(transactions)
        .join(reference, "tr_code")
        .groupBy(*STAFF)
        .agg(F.sum("txn_count").alias("txn_count"), *[p for name in AMOUNTS for p in N.merge_parts(name)])
        .select(*STAFF, "txn_count", *_totals())
    )


def monthly_trends(transactions: DataFrame) -> DataFrame:
    """Count and net sum by year and month of all valid transactions; the month stays text."""
    return (
        transactions.groupBy("year", "month")
        .agg(F.count("*").alias("txn_count"), *N.sum_parts("net_amount", "net_amount"))
        .select("year", "month", "txn_count", N.parts_total("net_amount").alias("total_net_spend"))
    )


def account_summary(transactions: DataFrame) -> DataFrame:
    """Net sum and count by account of all valid transactions."""
    return (
        transactions.groupBy("account_name")
        .agg(F.count("*").alias("txn_count"), *N.sum_parts("net_amount", "net_amount"))
        .select("account_name", N.parts_total("net_amount").alias("total_net_spend"), "txn_count")
    )


def active_staff(transactions: DataFrame, reference: DataFrame) -> DataFrame:
    """Distinct staff ids that have transactions."""
    codes = transactions.select("tr_code").distinct()
    return reference.join(codes, "tr_code", "left_semi").select("staff_id").distinct()


def staff_statement(transactions: DataFrame, reference: DataFrame, staff_id: str) -> DataFrame:
    """The joined rows of one member of staff; only their codes are read from the reference."""
    one = reference.where(F.col("staff_id") == staff_id)
    return joined(transactions, one).select(*STATEMENT_COLUMNS)


def staff_totals(transactions: DataFrame, reference: DataFrame) -> DataFrame:
    """Per staff id: row count, sums, and the names and email of the first row in source order."""
    return (
        code_totals(transactions)
        .join(reference.where(F.col("staff_id").isNotNull()), "tr_code")
        .groupBy("staff_id")
        .agg(
            F.sum("txn_count").alias("txn_count"),
            *[p for name in AMOUNTS for p in N.merge_parts(name)],
            F.min_by(F.struct("first_name", "family_name", "email"), "first_row").alias("first"),
        )
        .select("staff_id", "first.*", "txn_count", *_totals())
    )


def statements(transactions: DataFrame, reference: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """All statements in one table: the joined rows, and for each member of staff a TOTAL row.

    The TOTAL row carries the staff id, which says whose statement it closes, and nothing else but the sums.
    """
    totals = staff_totals(transactions, reference) if totals is None else totals
    known = reference.where(F.col("staff_id").isNotNull())
    detail = joined(transactions, known).select(*STATEMENT_COLUMNS, "src_row", F.lit(False).alias("is_total"))
    total_rows = totals.select(
        "staff_id",
        F.lit("TOTAL").alias("description"),
        F.col("total_debit").alias("debit"),
        F.col("total_credit").alias("credit"),
        F.col("total_net_spend").alias("net_amount"),
        F.lit(True).alias("is_total"),
    )
    return detail.unionByName(total_rows, allowMissingColumns=True)


@dataclass(frozen=True)
class Letter:
    """Names and contacts that go into the messages."""

    title: str = "Statement"
    sender: str = "finance@example.org"
    cc: str = ""
    general_contact: str = "office@example.org"
    finance_contact: str = "finance@example.org"
    signature: str = "Finance"


# Fixed value: the text of a message.
BODY = """Hi %s,

Attached is a summary of your %s transaction(s).

Debit: $%s
Credit: $%s
Net Amount: $%s

This is an automated email based on transaction data.
Please review monthly for any discrepancies.
For general questions contact: {general_contact}
For financial queries contact: {finance_contact}

Kind regards,
{signature}
"""


def statement_name(title: str) -> Column:
    return F.concat_ws("_", F.lit(title), X.safe_name("first_name", "family_name"), "staff_id")


def messages(totals: DataFrame, letter: Letter = Letter()) -> DataFrame:
    """A message row per member of staff, out of their totals."""
    contacts = {
        name: getattr(letter, name).replace("%", "%%")
        for name in ("general_contact", "finance_contact", "signature")
    }
    amounts = [F.format_number(c, 2) for c in ("total_debit", "total_credit", "total_net_spend")]
    return totals.select(
        "staff_id",
        F.concat(F.lit(f"{letter.title} - "), X.safe_name("first_name", "family_name")).alias("subject"),
        F.lit(letter.sender).alias("sender"),
        F.coalesce("email", F.lit("None")).alias("recipient"),
        F.lit(letter.cc).alias("cc"),
        F.format_string(
            BODY.format(**contacts), X.shown("first_name"), F.col("txn_count").cast("string"), *amounts
        ).alias("body"),
        statement_name(letter.title).alias("attachment_name"),
    )
