"""Dates hidden in text, and month keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The field name in the details text and its date format.
FIRST_AVAILABLE = r'"Date First Available":\s*"([^"]+)"'
FIRST_AVAILABLE_FORMAT = "MMMM d, yyyy"


def first_available_date(details: Column) -> Column:
    """Date from a details text; null when the field is absent or in another format."""
    return F.try_to_date(F.regexp_extract(details, FIRST_AVAILABLE, 1), FIRST_AVAILABLE_FORMAT)


def month_start(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))


def days_before(anchor: Column, days: Column) -> Column:
    """The date so many days before ``anchor``; null if either is null, after it for negative days."""
    return F.date_sub(anchor, days.cast("int"))
