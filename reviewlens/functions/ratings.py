"""Numbers: parsing, rounding and bucketing of ratings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DECIMAL_NUMBER = r"^[ \t\r\n]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t\r\n]*$"


def finite(value: Column) -> Column:
    """``value``, or null for NaN and the infinities."""
    return F.when(~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))), value)


def _number(text: Column) -> Column:
    """A cast alone would take ``nan``, ``4.5f`` and hexadecimal numbers too."""
    return F.when(text.rlike(_DECIMAL_NUMBER), F.btrim(text, F.lit(" \t\r\n")).try_cast("double"))


def parse_rating(text: Column) -> Column:
    """Text to a finite double; anything that is no plain decimal number is null."""
    infinity = F.lit(float("inf"))
    return F.nullif(F.nullif(_number(text), infinity), -infinity)


def is_rating(text: Column) -> Column:
    """Whether ``parse_rating`` gives a value; as a filter it reads the text once."""
    return F.coalesce(F.abs(_number(text)) < F.lit(float("inf")), F.lit(False))


def rated(rating: Column) -> Column:
    """Whether there is a rating: NaN is none, it would spoil every mean it enters."""
    return rating.isNotNull() & ~F.isnan(rating)


def two_decimals(mean: Column) -> Column:
    """Half-up to two decimals, stable against the order in which a mean was summed.

    A mean of short decimals such as 2.675 may come out one unit in the last
    place lower or higher, depending on how tasks merged their partial sums.
    Rounding at nine decimals first removes that noise, so ties always go the
    same way and a ranking on the result is repeatable.
    """
    return F.round(F.round(mean, 9), 2)


def star(rating: Column) -> Column:
    """Nearest whole star, halves up."""
    return F.round(rating).cast("int")


def half_step(rating: Column, width: float = 0.5) -> Column:
    """Lower edge of the bucket a rating falls in."""
    return F.floor(rating / F.lit(width)) * F.lit(width)


def percent(part: Column, whole: Column) -> Column:
    """Share in percent; null when the whole is zero."""
    return F.try_divide(part * F.lit(100.0), whole)
