"""Text cleaning and guarded parsing of untrusted values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted number formats. \z and not $, which in Java also
# matches before a final newline.
INTEGER_PATTERN = r"^[+-]?[0-9]+\z"
DECIMAL_PATTERN = r"^[+-]?[0-9]+(\.[0-9]{1,2})?\z"

# Digits allowed before a value is out of range without parsing,
# the limits of each width and the code reported beyond them.
INTEGER_WIDTHS = {
    "smallint": (5, -(2**15), 2**15 - 1, "SMALLINT_OUT_OF_RANGE"),
    "int": (10, -(2**31), 2**31 - 1, "INTEGER_OUT_OF_RANGE"),
    "bigint": (19, -(2**63), 2**63 - 1, "BIGINT_OUT_OF_RANGE"),
}
DECIMAL_DIGITS = 20


def blank_to_null(value: Column) -> Column:
    """Strip spaces (only spaces) and turn what is then empty into NULL."""
    return F.nullif(F.trim(value), F.lit(""))


def canonical(value: Column, spellings: dict[str, str]) -> Column:
    """Replace known alternative spellings."""
    result = value
    for spelling, target in spellings.items():
        result = F.when(value == spelling, F.lit(target)).otherwise(result)
    return result


def is_integer_text(value: Column) -> Column:
    return value.rlike(INTEGER_PATTERN)


def is_decimal_text(value: Column) -> Column:
    return value.rlike(DECIMAL_PATTERN)


def digit_width(value: Column) -> Column:
    """Length without leading signs; leading zeros and the point count."""
    return F.length(F.ltrim(value, F.lit("+-")))


def parse_integer(value: Column, width: str = "int") -> Column:
    """Exact number of an integer text short enough for ``width``, else NULL."""
    digits = INTEGER_WIDTHS[width][0]
    guard = is_integer_text(value) & (digit_width(value) <= digits)
    return F.when(guard, value.try_cast("decimal(20,0)"))


def parse_decimal(value: Column) -> Column:
    """Exact number of a decimal text of at most 20 characters, else NULL."""
    guard = is_decimal_text(value) & (digit_width(value) <= DECIMAL_DIGITS)
    return F.when(guard, value.try_cast("decimal(38,2)"))


def narrow(number: Column, type_name: str) -> Column:
    """Narrow a wide number; what does not fit becomes NULL."""
    return number.try_cast(type_name)


def within_width(number: Column, width: str) -> Column:
    _, low, high, _ = INTEGER_WIDTHS[width]
    return number.between(F.lit(low).cast("decimal(20,0)"), F.lit(high).cast("decimal(20,0)"))
