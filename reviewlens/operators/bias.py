"""Does the length of a review go with its rating?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions import (
    LENGTH_EDGES,
    LENGTH_LABELS,
    length_bucket,
    rated,
    safe_corr,
    star,
)
from reviewlens.operators.ratings import merge_partials, partial_ratings


def length_partials(
    df: DataFrame,
    length_col: str = "review_length",
    rating_col: str = "rating",
    by: Sequence[str] = (),
    edges: Sequence[int] = LENGTH_EDGES,
    labels: Sequence[str] = LENGTH_LABELS,
) -> DataFrame:
    """Partial state per length bucket and whole-star rating."""
    measured = df.filter(F.col(length_col).isNotNull() & rated(F.col(rating_col))).select(
        *by,
        length_bucket(F.col(length_col), edges, labels).alias("length_bucket"),
        star(F.col(rating_col)).alias("rating_rounded"),
        F.col(rating_col),
    )
    return partial_ratings(measured, [*by, "length_bucket", "rating_rounded"], rating_col)


def bucket_stats(partials: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    merged = merge_partials(partials, [*by, "length_bucket"])
    return merged.select(
        *by,
        "length_bucket",
        (F.col("rating_sum") / F.col("review_count")).alias("avg_rating"),
        F.col("review_count").alias("count"),
    )


def rating_pivot(
    partials: DataFrame, by: Sequence[str] = (), labels: Sequence[str] = LENGTH_LABELS
) -> DataFrame:
    """Reviews per whole-star rating, one column per bucket in bucket order, 0 where none."""
    pivoted = partials.groupBy(*by, "rating_rounded").pivot("length_bucket", list(labels))
    return pivoted.agg(F.sum("review_count")).fillna(0, list(labels))


def length_correlation(
    df: DataFrame,
    length_col: str = "review_length",
    rating_col: str = "rating",
    by: Sequence[str] = (),
) -> DataFrame:
    """Pearson correlation; null where either column is constant."""
    rating = F.when(rated(F.col(rating_col)), F.col(rating_col))
    return df.groupBy(*by).agg(safe_corr(F.col(length_col), rating).alias("correlation"))


def length_bias(
    df: DataFrame,
    length_col: str = "review_length",
    rating_col: str = "rating",
    by: Sequence[str] = (),
) -> dict[str, DataFrame]:
    partials = length_partials(df, length_col, rating_col, by)
    return {
        "bucket_stats": bucket_stats(partials, by),
        "rating_pivot": rating_pivot(partials, by),
        "correlation": length_correlation(df, length_col, rating_col, by),
    }
