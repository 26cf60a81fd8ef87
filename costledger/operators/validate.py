"""Rules over produced tables; each rule gives rows of file, row number, rule and message."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from costledger.functions import numbers as N
from costledger.functions import text as X
from costledger.operators.numbering import BLOCK, previous_value
from costledger.schemas import VIOLATION
from costledger.session import materialise

TOLERANCE = "0.01"
MESSAGES_PER_FILE = 5

# The tables that a package must hold.
REQUIRED_TABLES = ("Transaction_Ledger", "All_Spenders", "Monthly_Trends", "Spending_by_Account")


def _at_row(text: str, value: Column | None = None) -> Column:
    parts = [F.col("file_key"), F.lit(f": {text} at row "), F.col("row_num").cast("string")]
    if value is not None:
        parts += [F.lit(": '"), F.coalesce(value, F.lit("")), F.lit("'")]
    return F.concat(*parts)


def _row_violations(rows: DataFrame, checks: Sequence[tuple[Column, str, Column]]) -> DataFrame:
    """A violation for each check (condition, rule, message) that a row fails; all checks in one pass."""
    failed = [
        F.when(bad, F.struct(F.lit(rule).alias("rule"), message.alias("message"))) for bad, rule, message in checks
    ]
    return rows.select(
        "file_key",
        F.col("row_num").cast("bigint").alias("row_num"),
        F.inline(F.array_compact(F.array(*failed))),
    )


def _on_file(spark: SparkSession, file_key: str, rule: str, text: str) -> DataFrame:
    return spark.createDataFrame([(file_key, None, rule, f"{file_key}: {text}")], VIOLATION)


def absent_columns(df: DataFrame, labels: Mapping[str, str]) -> list[str]:
    """Labels of the columns that the table lacks."""
    present = {c.lower() for c in df.columns}
    return [label for column, label in labels.items() if column not in present]


def missing_tables(present: DataFrame, required: Sequence[str] = REQUIRED_TABLES) -> DataFrame:
    """Required tables that a package (``file_key``) does not list among its ``name`` values."""
    listed = present.groupBy("file_key").agg(
        *[F.bool_or(F.coalesce(F.col("name") == name, F.lit(False))).alias(f"_{i}") for i, name in enumerate(required)]
    )
    absent = [F.when(~F.col(f"_{i}"), F.lit(name)) for i, name in enumerate(required)]
    return listed.select("file_key", F.explode(F.array_compact(F.array(*absent))).alias("name")).select(
        "file_key",
        F.lit(None).cast("bigint").alias("row_num"),
        F.lit("missing table").alias("rule"),
        F.concat(F.col("file_key"), F.lit(": missing "), F.col("name")).alias("message"),
    )


def _has_codes(rows: DataFrame) -> bool:
    return "tr_code" in [c.lower() for c in rows.columns]


def _code_checks(rows: DataFrame) -> list:
    if not _has_codes(rows):
        return []
    code = F.coalesce(X.ustrip("tr_code"), F.lit(""))
    return [(~X.is_tr_code(code), "tr_code", _at_row("invalid TR_Code", code))]


def _number_checks(column: str, value: Column, label: str) -> list:
    """Cells without a number, or with something else."""
    blank = X.is_blank(column)
    return [
        (value.isNull() & blank, "missing value", _at_row(f"missing {label}")),
        (value.isNull() & ~blank, "invalid number", _at_row(f"invalid {label}", X.ustrip(column))),
    ]


def code_violations(rows: DataFrame) -> DataFrame:
    """Codes that are not exactly seven digits, on every row; none where there is no such column."""
    if not _has_codes(rows):
        return no_violations(rows.sparkSession)
    return _row_violations(rows, _code_checks(rows))


def _until_first(violations: DataFrame, order_violations: DataFrame) -> DataFrame:
    """Of each file, what comes up to its first order violation: the file is not read further."""
    first = order_violations.groupBy("file_key").agg(F.min("row_num").alias("_stop"))
    both = violations.unionByName(order_violations).join(first, "file_key", "left")
    return both.where(F.col("_stop").isNull() | (F.col("row_num") <= F.col("_stop"))).select(*VIOLATION.names)


def amount_order_violations(rows: DataFrame, column: str = "total_net_spend") -> DataFrame:
    """Amounts that rise from one row to the next, in files sorted by falling amount.

    Cells that do not read as a number are reported and skipped. Codes are checked too where there are any.
    """
    label = "Total_Net_Spend" if column == "total_net_spend" else column
    value = F.col("_value")
    typed = rows.withColumn("_text", X.computed_once(N.number_text(column)))
    typed = typed.withColumn("_value", X.computed_once(N.exact_number(F.col("_text"))))
    compared = previous_value(
        typed.where(value.isNotNull()).select("file_key", "row_num", "_value"), "file_key", "row_num", "_value"
    )
    order = _row_violations(
        compared, [(N.exceeds(value, F.col("previous")), "not sorted", _at_row(f"{label} not sorted DESC"))]
    )
    cells = _row_violations(typed, [*_number_checks(column, value, label), *_code_checks(rows)])
    return _until_first(cells, order)


def month_order_violations(rows: DataFrame) -> DataFrame:
    """Years that rise, or months that rise as text within a year, in files sorted by both, falling."""
    year, month = F.col("_year"), F.col("_month")
    typed = rows.withColumns({"_text": X.computed_once(N.number_text("year")), "_month": X.ustrip("month")})
    typed = typed.withColumn("_year", X.computed_once(N.exact_number(F.col("_text"))))
    whole, blank = N.is_whole_number(year), X.is_blank("month")
    key = F.struct(year.alias("year"), month.alias("month"))
    readable = typed.where(whole & ~blank).select("file_key", "row_num", key.alias("_key"))
    compared = previous_value(readable, "file_key", "row_num", "_key")
    year_rises = N.exceeds(F.col("_key.year"), F.col("previous.year"))
    same_year = F.col("previous").isNotNull() & ~year_rises & ~N.exceeds(F.col("previous.year"), F.col("_key.year"))
    order = _row_violations(
        compared,
        [
            (year_rises, "not sorted", _at_row("Year not sorted DESC")),
            (same_year & (F.col("_key.month") > F.col("previous.month")), "not sorted", _at_row("Month not sorted DESC")),
        ],
    )
    cells = _row_violations(
        typed,
        [
            *_number_checks("year", year, "Year"),
            (~whole, "not whole", _at_row("Year not an integer")),
            (whole & blank, "missing value", _at_row("missing Month")),
            *_code_checks(rows),
        ],
    )
    return _until_first(cells, order)


# The amount columns of a statement and their labels.
STATEMENT_AMOUNTS = {"debit": "Debit", "credit": "Credit", "net_amount": "Net_Amount"}
# Amounts that a decimal holds, longer ones, and cells that are no amounts.
HELD, LONG, INVALID = 0, 1, 2


def total_violations(rows: DataFrame, tolerance: str = TOLERANCE) -> DataFrame:
    """Statements without exactly one TOTAL row, or with totals that differ from the sum of the other rows.

    A TOTAL row is flagged by ``is_total`` or, where the table has no such column, by its description. Of several
    the last counts. The sums come out of one grouped pass over the rows, without sorting them. Sums are exact: amounts that
    a decimal does not hold at a glance are added by their digits, in a second pass over files that have such.
    """
    if "is_total" in rows.columns:
        is_total = F.coalesce(F.col("is_total"), F.lit(False))
    else:
        is_total = F.coalesce(X.ustrip("description") == "TOTAL", F.lit(False))
    cells = [c for c in rows.columns if c not in ("file_key", "row_num", "is_total")]
    filled = rows.where(~X.all_missing(cells))
    read = filled.select(
        "file_key",
        "row_num",
        is_total.alias("_total"),
        *[X.computed_once(F.when(X.is_blank(c), F.lit("0")).otherwise(N.number_text(c, ""))).alias(c) for c in STATEMENT_AMOUNTS],
    )
    numbers = read.withColumns({c: X.computed_once(N.exact_number(F.col(c))) for c in STATEMENT_AMOUNTS})
    # the parsed cells are read by the sums and by the checks of cells, so they are stored
    typed = materialise(
        numbers.select(
            "file_key",
            "row_num",
            "_total",
            *[F.col(c)["d"].cast(N.AMOUNT).alias(c) for c in STATEMENT_AMOUNTS],
            *[F.when(N.is_amount(F.col(c)), F.col(c)["t"]).alias(f"text_{c}") for c in STATEMENT_AMOUNTS],
        ),
        "statement_cells",
    )
    total_row = F.when(F.col("_total"), F.coalesce("row_num", F.lit(0)).cast("bigint"))

    def state(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), HELD).when(F.col(f"text_{c}").isNotNull(), LONG).otherwise(INVALID)

    # single values and not a struct of them: Spark aggregates those by hash, without sorting the rows
    sums = [
        part
        for c in STATEMENT_AMOUNTS
        for part in N.sum_parts(c, F.when(~F.col("_total"), F.col(c).cast("double")), F.col(c))
    ]
    per_file = typed.groupBy("file_key").agg(
        F.count_if("_total").alias("n_totals"),
        F.max(total_row).alias("last_total"),
        *[F.max_by(F.when(F.col("_total"), F.col(c)), total_row).alias(f"total_{c}") for c in STATEMENT_AMOUNTS],
        *[F.max_by(F.when(F.col("_total"), state(c)), total_row).alias(f"state_{c}") for c in STATEMENT_AMOUNTS],
        *[F.count_if(~F.col("_total") & (state(c) == LONG)).alias(f"n_long_{c}") for c in STATEMENT_AMOUNTS],
        *sums,
    )
    zero = F.lit(0).cast(N.STRICT)
    differences = {f"diff_{c}": N.parts_decimal(c) - F.coalesce(f"total_{c}", zero) for c in STATEMENT_AMOUNTS}
    differs = {f"differs_{c}": F.abs(F.col(f"diff_{c}")) > F.lit(tolerance).cast(N.STRICT) for c in STATEMENT_AMOUNTS}
    long = {f"long_{c}": (F.col(f"n_long_{c}") > 0) | F.coalesce(F.col(f"state_{c}") == LONG, F.lit(False)) for c in STATEMENT_AMOUNTS}
    per_file = materialise(per_file.withColumns(differences).withColumns(differs).withColumns(long), "statement_sums")
    any_long = F.greatest(*[F.col(name) for name in long])
    if not per_file.where(any_long).isEmpty():
        per_file = _with_long_amounts(per_file, typed.where(F.greatest(*[state(c) == LONG for c in STATEMENT_AMOUNTS])), any_long, tolerance)
    no_row = F.lit(None).cast("bigint")
    has_total = F.col("n_totals") > 0

    def entry(rule: str, text: str, copies: Column) -> Column:
        return F.struct(F.lit(rule).alias("rule"), F.lit(text).alias("text"), copies.cast("int").alias("copies"))

    def finding(bad: Column, rule: str, text: str) -> Column:
        return F.when(bad, entry(rule, text, F.lit(1)))

    # each TOTAL row after the first is reported; in blocks, as one array for all could grow with the file
    extra = F.col("n_totals") - 1
    blocks = F.when(extra > 0, F.sequence(F.lit(0).cast("bigint"), F.floor((extra - 1) / BLOCK)))
    repeated = F.transform(
        F.coalesce(blocks, F.array().cast("array<bigint>")),
        lambda block: entry("several totals", "multiple TOTAL rows found", F.least(F.lit(BLOCK), extra - block * BLOCK)),
    )
    findings = F.array_compact(
        F.array(
            finding(~has_total, "no total", "TOTAL row not found"),
            *[
                finding(has_total & (F.col(f"state_{c}") == INVALID), "invalid number", f"invalid {label} at row 0")
                for c, label in STATEMENT_AMOUNTS.items()
            ],
            *[
                finding(has_total & F.col(f"differs_{c}"), "total differs", f"TOTAL {label} does not match recomputed sum")
                for c, label in STATEMENT_AMOUNTS.items()
            ],
        )
    )
    on_files = (
        per_file.select("file_key", F.inline(F.concat(repeated, findings)))
        .select("file_key", "rule", "text", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select(
            "file_key",
            no_row.alias("row_num"),
            "rule",
            F.concat(F.col("file_key"), F.lit(": "), F.col("text")).alias("message"),
        )
    )
    bad_cells = F.array_compact(
        F.array(*[F.when(state(c) == INVALID, F.lit(label)) for c, label in STATEMENT_AMOUNTS.items()])
    )
    on_cells = typed.where(~F.col("_total")).select("file_key", "row_num", F.explode(bad_cells).alias("label")).select(
        "file_key",
        F.col("row_num").cast("bigint").alias("row_num"),
        F.lit("invalid number").alias("rule"),
        F.concat(
            F.col("file_key"), F.lit(": invalid "), F.col("label"), F.lit(" at row "), F.col("row_num").cast("string")
        ).alias("message"),
    )
    return on_cells.unionByName(on_files)


def _with_long_amounts(per_file: DataFrame, cells: DataFrame, any_long: Column, tolerance: str) -> DataFrame:
    """``per_file`` with ``differs_...`` corrected where long amounts are part of the sum or its total.

    The difference is added up in limbs: the long amounts of the rows, minus that of the total, plus the difference of the others.
    """
    files = per_file.where(any_long)
    names = list(STATEMENT_AMOUNTS)
    counted = cells.join(files.select("file_key", "last_total"), "file_key").where(
        ~F.col("_total") | (F.coalesce("row_num", F.lit(0)) == F.col("last_total"))
    )
    sign = F.when(F.col("_total"), -1).otherwise(1)
    of_cells = counted.select(
        "file_key",
        sign.alias("sign"),
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"text_{c}").alias("text")) for c in names])),
    )
    of_others = files.select(
        "file_key",
        F.lit(1).alias("sign"),
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"diff_{c}").cast("string").alias("text")) for c in names])),
    )
    parts = (
        of_cells.unionByName(of_others).where("text IS NOT NULL")
        .select("file_key", "column", "sign", F.explode(N.limbs(F.col("text"))).alias("one"))
        .select("file_key", "column", "one.place", (F.col("sign") * F.col("one.value")).alias("value"), F.lit(0).cast("bigint").alias("allowed"))
    )
    limits = (
        files.select("file_key", F.explode(F.array(*[F.lit(c) for c in names])).alias("column"))
        .select("file_key", "column", F.explode(N.limbs(F.lit(tolerance))).alias("one"))
        .select("file_key", "column", "one.place", F.lit(0).cast("bigint").alias("value"), F.col("one.value").alias("allowed"))
    )
    added = parts.unionByName(limits).groupBy("file_key", "column", "place").agg(
        N.limb_sum(F.col("value")).alias("value"), N.limb_sum(F.col("allowed")).alias("allowed")
    )

    def beyond(c: str, direction: int) -> Column:
        """Whether the difference, or its negative, is beyond the tolerance."""
        value = (direction * F.col("value") - F.col("allowed")).cast("decimal(29,0)")
        own = F.collect_list(F.when(F.col("column") == c, F.struct("place", value.alias("value"))))
        return N.limb_sign(F.sort_array(own, asc=False)) > 0

    # the places of a sum are few: a ninth of its digits
    found = added.groupBy("file_key").agg(*[(beyond(c, 1) | beyond(c, -1)).alias(f"found_{c}") for c in names])
    joined = per_file.join(found, "file_key", "left")
    corrected = {f"differs_{c}": F.when(F.col(f"long_{c}"), F.col(f"found_{c}")).otherwise(F.col(f"differs_{c}")) for c in names}
    return joined.withColumns(corrected).drop(*[f"found_{c}" for c in names])


# The rules in the order in which a file is checked, first as a whole, then row by row, then its totals.
FILE_RULES = ("no package", "missing table", "header", "columns")
ROW_RULES = ("tr_code", "missing value", "invalid number", "not whole", "not sorted")
TOTAL_RULES = ("several totals", "no total", "total differs")


def first_messages(violations: DataFrame, limit: int = MESSAGES_PER_FILE) -> DataFrame:
    """The first messages of each file, in the order of the checks; the rest is only counted, by ``error_counts``.

    Spark keeps the first rows of each file in every task before the shuffle.
    """
    place = F.array_position(F.lit([*FILE_RULES, *ROW_RULES, *TOTAL_RULES]), F.col("rule"))
    order = W.partitionBy("file_key").orderBy(
        (place > len(FILE_RULES)).asc(), F.col("row_num").asc_nulls_last(), place, "message"
    )
    return violations.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= limit).drop("_rank")


def error_counts(violations: DataFrame) -> DataFrame:
    return violations.groupBy("file_key").agg(F.count("*").alias("n_errors"))


def verdict(violations: DataFrame) -> DataFrame:
    """One row: PASS or FAIL, number of violations and of files that have any."""
    return error_counts(violations).agg(
        F.when(F.count("*") == 0, "PASS").otherwise("FAIL").alias("verdict"),
        F.coalesce(F.sum("n_errors"), F.lit(0)).cast("bigint").alias("n_errors"),
        F.count("*").alias("n_files"),
    )


def no_violations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], VIOLATION)


# Columns without which a table's rule is skipped, with their labels, and the rule. Codes are checked in any table.
RULES = {
    "All_Spenders": ({"total_net_spend": "Total_Net_Spend"}, amount_order_violations),
    "Spending_by_Account": ({"total_net_spend": "Total_Net_Spend"}, amount_order_violations),
    "Monthly_Trends": ({"year": "Year", "month": "Month"}, month_order_violations),
    "Statements": ({"description": "Description", **STATEMENT_AMOUNTS}, total_violations),
}


def package_violations(spark: SparkSession, tables: Mapping[str, DataFrame], package: str = "package") -> DataFrame:
    """All rules over the tables of a package, by table name; each has ``row_num`` counted from 2.

    The spender and account tables are sorted by amount, the trends by month; ``Statements`` holds all
    statements, with ``file_key`` telling them apart.
    """
    listed = spark.createDataFrame([(package, name) for name in [*tables, None]], "file_key string, name string")
    found = [missing_tables(listed)]
    if not tables:
        found.append(_on_file(spark, package, "no package", "no output package found for validation"))
    for name, table in tables.items():
        labels, rule = RULES.get(name, ({}, code_violations))
        rows = table if "file_key" in table.columns else table.withColumn("file_key", F.lit(name))
        absent = absent_columns(table, labels)
        if not set(table.columns) - {"row_num", "file_key"}:
            found.append(_on_file(spark, name, "header", "missing header row"))
        elif absent:
            found.append(_on_file(spark, name, "columns", "missing " + " or ".join(absent) + " column"))
            found.append(code_violations(rows))
        else:
            found.append(rule(rows))
    return reduce(DataFrame.unionByName, found)
