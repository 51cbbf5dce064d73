"""Ratings over time: monthly, yearly, rolling, per category and per calendar month.

All frames derive from one partial state per month, so the input is scanned
and shuffled once and windows only ever see a few rows per year.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.functions import rated
from reviewlens.operators.ratings import merge_partials, partial_ratings

WINDOW_MONTHS = 3


def monthly_partials(
    df: DataFrame, date_col: str = "timestamp", rating_col: str = "rating", by: Sequence[str] = ()
) -> DataFrame:
    dated = df.filter(F.col(date_col).isNotNull() & rated(F.col(rating_col))).select(
        *by, F.year(date_col).alias("year"), F.month(date_col).alias("month"), F.col(rating_col)
    )
    return partial_ratings(dated, [*by, "year", "month"], rating_col)


def _averaged(partials: DataFrame) -> DataFrame:
    keys = [c for c in partials.columns if c not in ("rating_sum", "review_count")]
    mean = F.col("rating_sum") / F.col("review_count")
    return partials.select(*keys, mean.alias("avg_rating"), "review_count")


def monthly(partials: DataFrame) -> DataFrame:
    return _averaged(partials)


def yearly(partials: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return _averaged(merge_partials(partials, [*by, "year"]))


def seasonality(partials: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Calendar months over all years."""
    return _averaged(merge_partials(partials, [*by, "month"]))


def rolling(
    partials: DataFrame, by: Sequence[str] = (), months: int = WINDOW_MONTHS, calendar: bool = False
) -> DataFrame:
    """Unweighted mean of the last monthly means; the first rows have a shorter frame.

    By default the frame counts rows, so a month without reviews is skipped
    over. ``calendar=True`` counts calendar months instead.
    """
    if calendar:
        window = Window.partitionBy(*by).orderBy(F.col("year") * 12 + F.col("month"))
        window = window.rangeBetween(-(months - 1), 0)
    else:
        window = Window.partitionBy(*by).orderBy("year", "month").rowsBetween(-(months - 1), 0)
    means = _averaged(partials)
    return means.select(
        *by, "year", "month", "avg_rating", F.avg("avg_rating").over(window).alias("rolling_avg")
    )


def rating_trends(
    df: DataFrame, date_col: str = "timestamp", rating_col: str = "rating", by: Sequence[str] = ()
) -> dict[str, DataFrame]:
    partials = monthly_partials(df, date_col, rating_col, by)
    return {
        "monthly": monthly(partials),
        "yearly": yearly(partials, by),
        "rolling": rolling(partials, by),
    }


def category_trend(
    df: DataFrame, date_col: str = "timestamp", rating_col: str = "rating"
) -> DataFrame:
    return monthly(monthly_partials(df, date_col, rating_col, ["category"]))
