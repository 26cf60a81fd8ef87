"""Numbers out of text, and exact sums of money."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from costledger.functions.text import _col, is_blank, strip_all

# Texts that count as a number, with grouping underscores, and without but with infinity.
FLOAT_TEXT = r"\A[+-]?([0-9](_?[0-9])*\.?([0-9](_?[0-9])*)?|\.[0-9](_?[0-9])*)([eE][+-]?[0-9](_?[0-9])*)?\z"
LOOSE_TEXT = r"(?i)\A[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|inf(inity)?)\z"

# One amount: 18 digits before and 10 after the point. Sums keep 28 before the point.
AMOUNT = "decimal(28,10)"
STRICT = "decimal(38,10)"
# Counts and their sums, which may pass 64 bits.
COUNT = "decimal(38,0)"


# Texts of these characters only need no closer look before the cast.
_DIGITS = "0123456789.+-"


def _number_text(c: Column | str, ignored: str = "") -> Column:
    """A text without the ``ignored`` characters, ready for a cast, or NULL where it is no finite number.

    Most cells are plain digits and take the short way; the pattern and the strip are for the others.
    """
    cell = _col(c).cast("string")
    plain = F.translate(cell, _DIGITS + ignored, "") == ""
    cell = F.translate(cell, ignored, "") if ignored else cell
    text = strip_all(cell)
    return F.when(plain, cell).when(text.rlike(FLOAT_TEXT), F.translate(text, "_", ""))


def _as_double(c: Column | str, ignored: str = "") -> Column:
    number = _number_text(c, ignored).try_cast("double")
    # infinite minus itself is not a number; a test by ``when`` would parse the text twice
    return F.nanvl(number - number + number, F.lit(None).cast("double"))


def money(c: Column | str) -> Column:
    """Money text as double, NULL when missing, unreadable or not finite; ``$`` and ``,`` are ignored."""
    return _as_double(c, "$,")


def head_count(c: Column | str) -> Column:
    """Count text as whole decimal cut towards zero, NULL when missing or unreadable; only ``,`` is ignored."""
    number = _as_double(c, ",")
    # few counts are beyond 64 bits
    return F.coalesce(number.try_cast("bigint").cast(COUNT), (number - number % F.lit(1.0)).try_cast(COUNT))


def loose_number(c: Column | str) -> Column:
    """Number text as double with 0 for all that does not read as one; grouping and ``$`` do not, ``inf`` does."""
    cell = _col(c).cast("string")
    text = strip_all(cell)
    number = F.when(F.translate(cell, _DIGITS, "") == "", cell).when(text.rlike(LOOSE_TEXT), text)
    return F.coalesce(number.try_cast("double"), F.lit(0.0))


def whole_year(c: Column | str) -> Column:
    """Year as int: ``2023`` and ``2023.0`` alike, NULL for other text."""
    cell = _col(c).cast("string")
    text = F.regexp_replace(strip_all(cell), r"(?<=[0-9])\.0*\z", "")
    return F.when(F.translate(cell, "0123456789", "") == "", cell).otherwise(text).try_cast("int")


def number_text(c: Column | str, ignored: str = ",") -> Column:
    """The text of a number without white space and grouping, NULL for most other text; see ``exact_number``."""
    return _number_text(c, ignored)


def exact_number(text: Column) -> Column:
    """The number in a ``number_text``, of any size and without rounding, or NULL.

    ``d`` holds it as decimal where that is exact at a glance, as for most cells, else ``t`` holds its text. Compare with ``exceeds``.
    """
    # at most ten decimals if the point is among the last eleven characters, or none at all
    point = F.instr(text, ".")
    short = (F.length(text) <= 18) & ((point == 0) | (point >= F.length(text) - 10)) & ~F.contains(F.lower(text), F.lit("e"))
    d = F.when(short, text.try_cast(STRICT))
    t = F.when(~short & text.rlike(FLOAT_TEXT), text)
    return F.when(d.isNotNull() | t.isNotNull(), F.struct(d.alias("d"), t.alias("t")))


def _order(number: Column) -> Column:
    """Sign, place of the first digit and digits: sorts as the numbers do, of any length."""
    text = F.coalesce(number["t"], number["d"].cast("string"))
    exponent = F.coalesce(F.regexp_extract(text, r"[eE]([+-]?[0-9]+)\z", 1).try_cast("bigint"), F.lit(0))
    mantissa = F.translate(F.regexp_replace(text, "[eE].*", ""), "+-", "")
    whole, part = (F.split_part(mantissa, F.lit("."), F.lit(n)) for n in (1, 2))
    significant = F.ltrim(F.concat(whole, part), F.lit("0"))
    place = F.length(significant) - F.length(part) + exponent
    digits = F.rtrim(significant, F.lit("0"))
    # of negative numbers the longer and the larger ones come first
    turned = F.concat(F.translate(digits, "0123456789", "9876543210"), F.lit("~"))
    key = lambda sign, at, digits: F.struct(F.lit(sign).alias("sign"), at.cast("bigint").alias("place"), digits.alias("digits"))
    return F.when(digits == "", key(0, F.lit(0), F.lit(""))).when(text.startswith("-"), key(-1, -place, turned)).otherwise(key(1, place, digits))


def exceeds(left: Column, right: Column) -> Column:
    """Whether one exact number is larger than another; not if either is NULL."""
    both = left["d"].isNotNull() & right["d"].isNotNull()
    missing = left.isNull() | right.isNull()
    return F.when(missing, False).when(both, left["d"] > right["d"]).otherwise(_order(left) > _order(right))


def is_whole_number(number: Column) -> Column:
    """Whether an exact number has no decimals."""
    key = _order(number)
    digits = F.length(F.translate(key["digits"], "~", ""))
    return F.when(number["d"].isNotNull(), number["d"] == F.floor(number["d"])).otherwise(digits <= key["place"] * key["sign"])


# Numbers of any length as whole multiples of powers of 10**9, so that sums of them need no common precision. A place
# counts those powers. Exponents beyond this size are no amounts.
LIMB_DIGITS = 9
MAX_EXPONENT = 10**15
_LIMB_SUM = "decimal(28,0)"
# A sum of limbs is below 10**20 for 10**11 rows, so a carry of this size decides the sign, whatever follows.
_DECIDED = "1000000000000"


def _exponent(text: Column) -> Column:
    """The exponent of a number text, 0 if it has none, NULL beyond the limit."""
    written = F.regexp_extract(text, r"[eE]([+-]?[0-9]+)\z", 1)
    exponent = F.when(written == "", F.lit(0).cast("bigint")).otherwise(written.try_cast("bigint"))
    return F.when(F.abs(exponent) <= MAX_EXPONENT, exponent)


def is_amount(number: Column) -> Column:
    """Whether an ``exact_number`` is there and has an exponent that ``limbs`` takes."""
    return number["d"].isNotNull() | (number["t"].isNotNull() & _exponent(number["t"]).isNotNull())


def limbs(text: Column) -> Column:
    """The number in a text as array of ``place`` and ``value``, without those that are zero."""
    mantissa = F.translate(F.regexp_replace(text, "[eE].*", ""), "+-", "")
    whole, part = (F.split_part(mantissa, F.lit("."), F.lit(n)) for n in (1, 2))
    exponent = _exponent(text) - F.length(part)
    digits = F.concat(F.ltrim(F.concat(whole, part), F.lit("0")), F.repeat(F.lit("0"), F.pmod(exponent, F.lit(LIMB_DIGITS)).cast("int")))
    n = F.greatest(F.ceil(F.length(digits) / LIMB_DIGITS).cast("int"), F.lit(1))
    padded = F.lpad(digits, n * LIMB_DIGITS, F.lit("0"))
    lowest = F.floor(exponent / LIMB_DIGITS)
    sign = F.when(text.startswith("-"), -1).otherwise(1)

    def limb(i: Column) -> Column:
        value = F.substring(padded, i * LIMB_DIGITS + 1, F.lit(LIMB_DIGITS)).cast("bigint")
        return F.struct((lowest + (n - 1 - i)).cast("bigint").alias("place"), (sign * value).alias("value"))

    return F.filter(F.transform(F.sequence(F.lit(0), n - 1), limb), lambda one: one["value"] != 0)


def limb_sum(value: Column) -> Column:
    """Aggregate that adds limbs of one place."""
    return F.sum(value.cast("decimal(18,0)")).cast(_LIMB_SUM)


def limb_sign(added: Column) -> Column:
    """-1, 0 or 1: the sign of a sum, given as array of place and added value by falling place.

    Carried from the highest place down. Places without a limb are passed in one step.
    """
    limit = F.lit(_DECIDED).cast("decimal(13,0)")
    start = F.struct(F.lit(0).cast("decimal(13,0)").alias("carry"), F.lit(0).cast("bigint").alias("place"))

    def step(state: Column, one: Column) -> Column:
        gap = state["place"] - one["place"]
        # three or more places up, anything but zero outweighs one sum
        factor = F.when(gap <= 1, F.lit("1000000000")).when(gap == 2, F.lit("1" + "0" * 18)).otherwise(F.lit("1" + "0" * 24))
        total = state["carry"] * factor.cast("decimal(25,0)") + one["value"]
        carry = F.greatest(-limit, F.least(limit, total)).cast("decimal(13,0)")
        return F.struct(carry.alias("carry"), one["place"].alias("place"))

    return F.aggregate(added, start, step, lambda state: F.signum(state["carry"]).cast("int"))


def lenient_decimal(c: Column | str) -> Column:
    """Decimal out of text, 0 for NULL and blank; NULL when it does not read as one."""
    return F.when(is_blank(c), F.lit(0).cast(STRICT)).otherwise(_number_text(c).try_cast(STRICT))


def lenient_number(c: Column | str) -> Column:
    """The same as double."""
    return F.when(is_blank(c), 0.0).otherwise(_as_double(c))


def fixed_text(c: Column | str, places: int) -> Column:
    """Fixed number of decimals; rounds the exact value of the double, a tie to the even digit.

    ``round`` and ``format_string`` round the shortest decimal form instead: 0.00015 is below its tie, yet they
    round it up.
    """
    return F.call_function("format_number", _col(c), F.lit("0." + "0" * places))


def round_exact(c: Column | str, places: int) -> Column:
    return fixed_text(c, places).cast("double")


# Sums of doubles depend on the order of the rows, which a shuffle does not fix, and sums of decimals are slow. An amount
# of at most four decimals, below a hundred million, is a whole number of units; the upper and the lower bits of
# the units are summed apart, which neither rounds nor overflows below 9 * 10^12 rows. Other amounts are summed as
# decimals, and the rare value that does not fit one, or is infinite, as double.
_UNITS = 10_000.0
_UNIT_LIMIT = 1e8
_LOW_BITS = 20


def sum_parts(name: str, value: Column | str, decimal: Column | None = None) -> list[Column]:
    """Mergeable aggregates that together hold the sum of ``value``.

    ``decimal`` is the same number out of its text, for those that a double does not hold exactly.
    """
    x = _col(value)
    units = F.rint(x * _UNITS)
    short = (F.abs(x) < _UNIT_LIMIT) & (units / _UNITS == x)
    number = F.when(short, units.cast("bigint"))
    amount = F.when(~short, x if decimal is None else decimal).try_cast(AMOUNT)
    return [
        F.sum(F.shiftright(number, _LOW_BITS)).alias(f"{name}_high"),
        F.sum(number.bitwiseAND(F.lit(2**_LOW_BITS - 1))).alias(f"{name}_low"),
        F.sum(amount).alias(f"{name}_exact"),
        F.sum(F.when(~short & amount.isNull(), x)).alias(f"{name}_rest"),
    ]


def merge_parts(name: str) -> list[Column]:
    """Aggregates that add up the parts of finer groups."""
    return [F.sum(f"{name}_{part}").alias(f"{name}_{part}") for part in ("high", "low", "exact", "rest")]


def parts_decimal(name: str) -> Column:
    """The sum as decimal, but for the values that do not fit one."""
    zero = F.lit(0).cast("decimal(37,10)")
    high, low = (F.col(f"{name}_{part}").cast("decimal(19,0)") for part in ("high", "low"))
    units = high * F.lit(2**_LOW_BITS).cast("decimal(7,0)") + low
    short = (units * F.lit("0.0001").cast("decimal(4,4)")).cast("decimal(37,10)")
    return F.coalesce(short, zero) + F.coalesce(F.col(f"{name}_exact").cast("decimal(37,10)"), zero)


def parts_total(name: str) -> Column:
    """The sum as double, rounded once."""
    total = parts_decimal(name).cast("double")
    return F.when(F.col(f"{name}_rest").isNull(), total).otherwise(total + F.col(f"{name}_rest"))
