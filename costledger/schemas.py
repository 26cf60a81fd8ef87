"""Column names and types of the tables that the jobs read and write."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# needs no running session, unlike a DDL text
_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType()}


def _schema(columns: str) -> T.StructType:
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


CONTRACT_RAW = _schema(
    "school string, subject_no string, subject string, teaching_session string, "
    "incl_oncosts string, student_count string"
)

REFERENCE = _schema("tr_code string, staff_id string, first_name string, family_name string, email string")

TRANSACTION_RAW = _schema(
    "src_row bigint, activity string, debit string, credit string, net_amount string, "
    "year string, month string, journal_line_desc string"
)

TRANSACTION = _schema(
    "tr_code string, account_name string, debit double, credit double, net_amount double, "
    "year int, month string, description string, batch_id bigint, src_row bigint"
)

LEDGER_COLUMNS = [
    "batch_id", "tr_code", "account_name", "description", "debit", "credit", "net_amount",
    "year", "month", "staff_id", "first_name", "family_name", "email",
]

STATEMENT_COLUMNS = [
    "tr_code", "account_name", "debit", "credit", "net_amount", "year", "month", "description",
    "batch_id", "first_name", "family_name", "email", "staff_id",
]

VIOLATION = _schema("file_key string, row_num bigint, rule string, message string")


def underscore_headers(df: DataFrame) -> DataFrame:
    """Headers with spaces turned to underscores."""
    return df.withColumnsRenamed({c: c.replace(" ", "_") for c in df.columns if " " in c})


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the source headers present in ``df``, in any case."""
    present = {c.lower(): c for c in df.columns}
    return df.withColumnsRenamed({present[s.lower()]: t for s, t in names.items() if s.lower() in present})


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to ``schema`` in its order; columns that are absent become NULL, others are dropped."""
    present = {c.lower() for c in df.columns}
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name.lower() in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
