"""A table somewhere inside a raw sheet: find its header row, then read the rows below by position."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costledger.functions.text import HEADER_ALIASES, canonical_header
from costledger.schemas import CONTRACT_RAW

SCAN_ROWS = 30
SCAN_COLUMNS = 60


def _cells(sheet: DataFrame, columns: int) -> list[str]:
    return [f"_c{i}" for i in range(columns) if f"_c{i}" in sheet.columns]


def header_candidates(
    sheet: DataFrame,
    scan_rows: int = SCAN_ROWS,
    scan_columns: int = SCAN_COLUMNS,
    required: Sequence[str] = CONTRACT_RAW.names,
    aliases: Mapping[str, str] = HEADER_ALIASES,
) -> DataFrame:
    """Rows near the top of each sheet that name all required columns, with the position of each column.

    Of a header given twice the last position counts. Only the first ``scan_rows`` rows are read.
    """
    cells = F.array(*[F.col(c) for c in _cells(sheet, scan_columns)])
    named = (
        sheet.where(F.col("row_idx") <= scan_rows)
        .select("sheet_ord", "sheet", "row_idx", F.posexplode(cells).alias("position", "cell"))
        .select("sheet_ord", "sheet", "row_idx", "position", canonical_header("cell", dict(aliases)).alias("name"))
        .where(F.col("name").isin(*required))
    )
    return (
        named.groupBy("sheet_ord", "sheet", "row_idx")
        .agg(*[F.max(F.when(F.col("name") == r, F.col("position"))).alias(r) for r in required])
        .dropna(subset=list(required))
    )


def locate_table(sheet: DataFrame, **options) -> DataFrame:
    """The first header in the order of sheets and rows, as at most one row."""
    candidates = header_candidates(sheet, **options)
    return candidates.orderBy("sheet_ord", "row_idx").limit(1).withColumnRenamed("row_idx", "header_row")


def body_rows(sheet: DataFrame, located: DataFrame, required: Sequence[str] = CONTRACT_RAW.names) -> DataFrame:
    """The rows below the header as named columns; the one-row header is metadata and read on the driver."""
    found = located.first()
    if found is None:
        raise ValueError("Could not locate a table containing the required columns: " + ", ".join(required))
    below = sheet.where((F.col("sheet_ord") == found["sheet_ord"]) & (F.col("row_idx") > found["header_row"]))
    return below.select(*[F.col(f"_c{found[name]}").alias(name) for name in required])
