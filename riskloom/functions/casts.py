"""Casts that turn bad text into null instead of failing the job."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\n\r\x0b\x0c"
MISSING_MARKS = ("", "NaN", '"NaN"')

_WHOLE_OR_DECIMAL = r"^\s*[+-]?(\d+(\.\d*)?|\.\d*)\s*$"
_LEADING_DIGITS = r"^\s*([+-]?\d+)"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def missing_to_null(text: Column) -> Column:
    """Blank text and the JSON not-a-number token become null; other text is kept as is."""
    return F.when(~strip(text).isin(*MISSING_MARKS), text)


def lenient_int(text: Column) -> Column:
    """Text to int under either ANSI setting: ``1.0`` and ``' 7 '`` pass, the fraction is
    cut off, and anything else (exponents, words, overflow) is null. Plain whole numbers,
    the usual case, never reach the patterns."""
    digits = F.regexp_extract(text, _LEADING_DIGITS, 1)
    whole = F.when(digits == "", F.lit(0)).otherwise(digits.try_cast("int"))
    return F.coalesce(text.try_cast("int"), F.when(text.rlike(_WHOLE_OR_DECIMAL), whole))


def lenient_double(text: Column, keep_nan: bool = False) -> Column:
    number = text.try_cast("double")
    return number if keep_nan else F.when(~F.isnan(number), number)


def usable_numbers(numbers: Sequence[Column]) -> Column:
    """True where a model can take every number: none is null, NaN or infinite. Zero times
    such a value is not zero, so one sum tests them all, however many there are."""
    zeros = reduce(lambda a, b: a + b, [n.cast("double") * 0.0 for n in numbers], F.lit(0.0))
    return F.coalesce(zeros == 0.0, F.lit(False))


def usable_number(number: Column) -> Column:
    return usable_numbers([number])
