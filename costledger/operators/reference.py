"""Staff reference: normalised headers, padded codes, and checks over the whole table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costledger.functions.text import ustrip, zero_pad
from costledger.schemas import REFERENCE, conform, rename_columns, underscore_headers

# What each check is called, in the order in which they are reported.
MISSING_CODE = "missing TR_Code"
EMPTY_CODE = "empty TR_Code"
DUPLICATE_CODE = "duplicate TR_Code"
CHECKS = (MISSING_CODE, EMPTY_CODE, DUPLICATE_CODE)


def _normalised(raw: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    df = rename_columns(underscore_headers(raw), renames)
    if "tr_code" not in [c.lower() for c in df.columns]:
        raise ValueError("Reference data missing TR_Code column.")
    return conform(df, REFERENCE)


def prepare_reference(raw: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """The reference columns in order: codes padded to seven digits, ids stripped, absent columns NULL.

    ``renames`` maps other headers (after spaces became underscores) to these names. A missing id stays NULL.
    """
    return _normalised(raw, renames or {}).withColumns(
        {"tr_code": zero_pad(ustrip("tr_code")), "staff_id": ustrip("staff_id")}
    )


def reference_issues(raw: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Rule, padded code and number of rows for all that would make the reference unusable.

    Codes are counted once over the whole table; the three checks read the counts.
    """
    stripped = ustrip("tr_code")
    kind = F.when(stripped.isNull(), MISSING_CODE).when(
        (stripped == "") | (F.lower(stripped) == "nan"), EMPTY_CODE
    )
    counts = (
        _normalised(raw, renames or {})
        .groupBy(kind.alias("rule"), F.when(kind.isNull(), zero_pad(stripped)).alias("tr_code"))
        .agg(F.count("*").alias("n_rows"))
    )
    return counts.where(F.col("rule").isNotNull() | (F.col("n_rows") > 1)).select(
        F.coalesce("rule", F.lit(DUPLICATE_CODE)).alias("rule"), "tr_code", "n_rows"
    )


def check_reference(raw: DataFrame, renames: Mapping[str, str] | None = None) -> None:
    """Raise for the first kind of issue there is; at most three counts reach the driver."""
    found = {
        r["rule"]: r["n"]
        for r in reference_issues(raw, renames).groupBy("rule").agg(F.count("*").alias("n")).collect()
    }
    for rule in CHECKS:
        if rule in found:
            raise ValueError(f"Reference data contains {rule} values.")
