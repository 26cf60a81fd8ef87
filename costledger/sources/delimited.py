"""Delimited files with a header; every column is read as text and coerced later, once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costledger.operators.numbering import with_source

# Texts that common spreadsheet exports use for a missing cell.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

SUFFIXES = (".csv",)


def check_suffix(path: str, suffixes: tuple[str, ...] = SUFFIXES) -> None:
    """Reject a file type that no scan here reads; folders have no suffix and pass."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    if "." in name and not name.lower().endswith(suffixes):
        raise ValueError(f"Unsupported input file format: {name}")


def files_by_encoding(spark: SparkSession, path: str | list[str]) -> dict[str, list[str]]:
    """The files below ``path`` by encoding: UTF-8 where every line is valid UTF-8, else windows-1252.

    One distributed pass; a row per file reaches the driver. Name the encoding to save the pass.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    valid = lines.groupBy("file").agg(F.min(F.is_valid_utf8("value")).alias("valid"))
    groups: dict[str, list[str]] = {}
    for row in valid.orderBy("file").collect():
        groups.setdefault("UTF-8" if row["valid"] else "windows-1252", []).append(row["file"])
    return groups


def mark_missing(df: DataFrame, texts: tuple[str, ...] = MISSING_TEXTS) -> DataFrame:
    """NULL for the texts that stand for a missing cell, in all text columns."""
    return df.withColumns(
        {
            f.name: F.when(~F.col(f"`{f.name}`").isin(*texts), F.col(f"`{f.name}`"))
            for f in df.schema.fields
            if isinstance(f.dataType, T.StringType)
        }
    )


# Spark reads ISO-8859-1 but not windows-1252; the two differ in these characters.
WINDOWS = {chr(b): bytes([b]).decode("cp1252", "ignore") for b in range(0x80, 0xA0)}
WINDOWS = {latin: char for latin, char in WINDOWS.items() if char}


def _as_windows(df: DataFrame) -> DataFrame:
    """Text read as ISO-8859-1 as the windows-1252 that it is."""
    table = str.maketrans(WINDOWS)
    latin, windows = "".join(WINDOWS), "".join(WINDOWS.values())
    return df.select(*[F.translate(f"`{c}`", latin, windows).alias(c.translate(table)) for c in df.columns])


def _read_part(spark: SparkSession, files: list[str], encoding: str, multi_line: bool, keep_source: bool) -> DataFrame:
    windows = encoding.lower() in ("windows-1252", "cp1252")
    scan = _reader(spark, "ISO-8859-1" if windows else encoding, multi_line).csv(files)
    columns = _as_windows(scan) if windows else scan
    return with_source(columns) if keep_source else columns


def _reader(spark: SparkSession, encoding: str, multi_line: bool):
    # doubled quotes inside quotes, as spreadsheets write them
    return (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("enforceSchema", False)
    )


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    encoding: str = "auto",
    multi_line: bool = False,
    missing: bool = True,
    keep_source: bool = False,
) -> DataFrame:
    """All text columns of a delimited file or folder, or of several files with one header.

    ``encoding="auto"`` falls back to windows-1252 for files that are not UTF-8, file by file. ``multi_line``
    allows line breaks in quoted cells, at the price of one task per file. ``keep_source`` adds the file and split
    that ``number_source`` numbers rows by.
    """
    paths = [path] if isinstance(path, str) else list(path)
    for one in paths:
        check_suffix(one)
    groups = files_by_encoding(spark, paths) if encoding == "auto" else {encoding: paths}
    if not groups:
        groups = {"UTF-8": paths}
    parts = [_read_part(spark, files, enc, multi_line, keep_source) for enc, files in groups.items()]
    df = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)
    return mark_missing(df) if missing else df


def read_raw_cells(spark: SparkSession, path: str, columns: int = 60, encoding: str = "UTF-8") -> DataFrame:
    """Cells by position, ``_c0`` onwards, for a file whose header is not its first line.

    Short rows are filled with NULL. ``number_source(..., "row_idx", per_file=True, start=1)`` numbers the rows.
    """
    check_suffix(path)
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(columns)])
    return (
        spark.read.option("header", False)
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .schema(schema)
        .csv(path)
    )
