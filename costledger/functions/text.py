"""Text functions, and a guard against parsing texts twice."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the code points that a Unicode strip removes.
WHITESPACE = "".join(
    map(
        chr,
        [
            0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680,
            *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
        ],
    )
)

# The same set as a regular-expression class.
WHITESPACE_CLASS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

# Accepted spellings of the contract headers, after normalising.
HEADER_ALIASES = {
    "school": "school",
    "subject": "subject",
    "subject no": "subject_no",
    "subject no.": "subject_no",
    "subject number": "subject_no",
    "teaching session": "teaching_session",
    "incl oncosts": "incl_oncosts",
    "incl. oncosts": "incl_oncosts",
    "student count": "student_count",
}

# The words that mark a summary row.
SUMMARY_WORDS = ("total", "sum", "result")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_all(c: Column | str) -> Column:
    """Strip all Unicode white space, the plain way: for cells that are rarely looked at."""
    return F.btrim(_col(c).cast("string"), F.lit(WHITESPACE))


def ustrip(c: Column | str) -> Column:
    """Strip all Unicode white space; ``trim`` alone removes U+0020 only.

    A text that starts and ends with a visible ASCII character after ``trim`` needs no more, and most do: the strip by
    a set of characters takes several times as long.
    """
    text = _col(c).cast("string")
    trimmed = F.trim(text)
    last = F.substring(trimmed, -1, 1)
    plain = (trimmed >= "!") & (trimmed < "\x7f") & (last >= "!") & (last < "\x7f")
    return F.when(plain, trimmed).otherwise(strip_all(text))


def is_blank(c: Column | str) -> Column:
    """NULL, or nothing left after the strip."""
    return _col(c).isNull() | (strip_all(c) == "")


def normalise_header(c: Column | str) -> Column:
    """Stripped, lower case, runs of white space as one space; NULL becomes the empty text."""
    text = F.regexp_replace(ustrip(c), WHITESPACE_CLASS + "+", " ")
    return F.coalesce(F.lower(text), F.lit(""))


def canonical_header(c: Column | str, aliases: dict[str, str] = HEADER_ALIASES) -> Column:
    """The canonical name of a header cell; an unknown header keeps its stripped text."""
    table = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    return F.coalesce(F.try_element_at(table, normalise_header(c)), ustrip(c), F.lit(""))


def is_summary_word(c: Column | str) -> Column:
    return F.coalesce(F.lower(ustrip(c)).isin(*SUMMARY_WORDS), F.lit(False))


def extract_year(c: Column | str) -> Column:
    """The leftmost year of 1900 to 2099 anywhere in the text, also inside a longer run of digits."""
    return F.regexp_extract(_col(c), "(19|20)[0-9]{2}", 0).try_cast("int")


def extract_tr_code(c: Column | str) -> Column:
    """The seven digits at the start of the text after optional zeros, else NULL."""
    found = F.regexp_extract(_col(c), rf"\A{WHITESPACE_CLASS}*0*([0-9]{{7}})", 1)
    return F.when(F.length(found) == 7, found)


def zero_pad(c: Column | str, width: int = 7) -> Column:
    """Pad with zeros on the left to ``width``; longer text is kept whole and a sign stays in front."""
    text = _col(c)
    sign = F.substring(text, 1, 1)
    return (
        F.when(F.length(text) >= width, text)
        .when(sign.isin("+", "-"), F.concat(sign, F.lpad(F.substr(text, F.lit(2)), width - 1, "0")))
        .otherwise(F.lpad(text, width, "0"))
    )


def shown(c: Column | str) -> Column:
    """Text as shown in names and messages: stripped, a missing value as ``None``."""
    return F.coalesce(ustrip(c), F.lit("None"))


def safe_name(first: Column | str, family: Column | str) -> Column:
    return F.concat_ws("_", shown(first), shown(family))


def email_tokens(c: Column | str, min_length: int = 3) -> Column:
    """The parts of an address before the first ``@``, without the short ones; case is kept."""
    text = _col(c)
    parts = F.filter(F.split(F.substring_index(text, "@", 1), "[._-]"), lambda p: F.length(p) >= min_length)
    return F.when(text.contains("@"), parts).otherwise(F.array().cast("array<string>"))


def is_tr_code(c: Column | str) -> Column:
    """Exactly seven digits."""
    return F.coalesce(_col(c).rlike(r"\A[0-9]{7}\z"), F.lit(False))


def all_missing(columns: list[str]) -> Column:
    """No cell of the row has a value."""
    return F.coalesce(*[F.col(f"`{c}`").cast("string") for c in columns]).isNull()


def column_name(prefix: object, suffix: str) -> str:
    return f"{prefix} {suffix}"


def computed_once(c: Column) -> Column:
    """The same value, as a column that filters on it do not compute again.

    Catalyst pushes a filter below the projection that computes its input, and the texts are then parsed both for the
    filter and for the result. It leaves filters above a projection that depends on the task, as this one
    does in form only.
    """
    return F.when(F.spark_partition_id() >= 0, c)
