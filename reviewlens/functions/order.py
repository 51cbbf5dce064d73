"""Doubles rounded to fewer bits, and bands of doubles: keys in the order of the values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Significant bits of the number in the middle of two bands.
BAND_BITS = 13
_BITS = 53
_FAR, _SCALE = 2.0**900, 2.0**64


def rounded(value: Column, bits: int) -> Column:
    """A double rounded to its first ``bits`` significant bits, in the order of the values.

    Two subtractions around a product drop the rest, exactly (Veltkamp's splitting); numbers that the
    product would carry out of range are scaled by a power of two. For doubles other than NaN.
    """
    if bits >= _BITS:
        return value
    factor = F.lit(2.0 ** (_BITS - bits) + 1)

    def split(x: Column) -> Column:
        return x * factor - (x * factor - x)

    far = F.abs(value) > F.lit(_FAR)
    infinite = F.abs(value) == F.lit(float("inf"))
    scaled = F.when(infinite, value).otherwise(split(value / F.lit(_SCALE)) * F.lit(_SCALE))
    return F.when(far, scaled).otherwise(split(value))


def band(value: Column) -> Column:
    """Key of the band that a double falls in: bands follow one another in the order of their values.

    Values on either side of a number of 13 significant bits that is nearest to them make two bands. A
    band's values differ by less than one part in 8192, and no band reaches over a multiple of a half
    below 4096 or holds two numbers of three significant digits. Between one power of two and the next there
    are 8192 bands, whatever the values.
    """
    middle = rounded(value, BAND_BITS)
    return F.when(value >= middle, middle).otherwise(middle - F.abs(middle) * F.lit(2.0**-14))
