"""The table behind each chart: ordered, with axis values and labels ready to draw."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.functions import (
    LENGTH_LABELS,
    bucket_ordinal,
    correlation_band,
    fixed,
    month_start,
)


def _dated(df: DataFrame):
    return month_start(F.col("year"), F.col("month")).alias("date")


def monthly_chart(monthly: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return monthly.select(*by, _dated(monthly), "avg_rating", "review_count").orderBy(*by, "date")


def yearly_chart(yearly: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    year = F.col("year").cast("string").alias("year")
    return yearly.select(*by, year, "avg_rating", "review_count").orderBy(*by, "year")


def rolling_chart(rolling: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return rolling.select(*by, _dated(rolling), "avg_rating", "rolling_avg").orderBy(*by, "date")


def bucket_chart(
    bucket_stats: DataFrame, by: Sequence[str] = (), labels: Sequence[str] = LENGTH_LABELS
) -> DataFrame:
    return bucket_stats.select(
        *by,
        bucket_ordinal(F.col("length_bucket"), labels).alias("bucket_ord"),
        "length_bucket",
        "avg_rating",
        "count",
        F.format_string("n=%d", "count").alias("label"),
    ).orderBy(*by, "bucket_ord")


def stacked_chart(
    rating_pivot: DataFrame, by: Sequence[str] = (), labels: Sequence[str] = LENGTH_LABELS
) -> DataFrame:
    """Long form of the pivot; ``bottom`` is where a bucket's bar starts within its rating."""
    long = rating_pivot.unpivot([*by, "rating_rounded"], list(labels), "length_bucket", "count")
    long = long.withColumn("bucket_ord", bucket_ordinal(F.col("length_bucket"), labels))
    below = Window.partitionBy(*by, "rating_rounded").orderBy("bucket_ord").rowsBetween(
        Window.unboundedPreceding, -1
    )
    bottom = F.coalesce(F.sum("count").over(below), F.lit(0)).alias("bottom")
    return long.select(*by, "rating_rounded", "bucket_ord", "length_bucket", "count", bottom).orderBy(
        *by, "rating_rounded", "bucket_ord"
    )


def correlation_chart(correlation: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    value = F.col("correlation")
    return correlation.select(
        *by, value, fixed(value, 4, "undefined").alias("label"), correlation_band(value).alias("band")
    )


def _percent_label(df: DataFrame, by: Sequence[str], bucket: str) -> DataFrame:
    label = F.concat(fixed(F.col("percentage"), 1), F.lit("%")).alias("label")
    return df.select(*by, bucket, "count", "percentage", label).orderBy(*by, bucket)


def histogram_chart(histogram: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return _percent_label(histogram, by, "rating_bucket")


def star_chart(star_distribution: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return _percent_label(star_distribution, by, "star_rating")


def box_chart(basic_stats: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Five numbers and the mean, as an array for the box and as labels."""
    numbers = {"Min": "min", "Q1": "q1", "Median": "median", "Q3": "q3", "Max": "max", "Mean": "mean"}
    box = F.array(*[F.col(name) for label, name in numbers.items() if label != "Mean"])
    return basic_stats.select(
        *by,
        *numbers.values(),
        box.alias("box"),
        *[
            F.concat(F.lit(f"{label}: "), fixed(F.col(name), 2, "undefined")).alias(f"{name}_label")
            for label, name in numbers.items()
        ],
    )
