"""Mean and count of ratings per key.

Everything goes through one mergeable partial state, ``rating_sum`` and
``review_count``, so whole-table, incremental and streaming results agree.
Spark combines partials inside each map task before it shuffles: a key that
holds a third of all rows costs one partial row per task, not a hot reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions import clean_key, rated, two_decimals
from reviewlens.operators.prepare import dual_keys, truthy_pairs

STATE = ("rating_sum", "review_count")


def partial_ratings(df: DataFrame, keys: Sequence[str], rating: str = "rating") -> DataFrame:
    return df.groupBy(*keys).agg(
        F.sum(rating).alias("rating_sum"), F.count(rating).alias("review_count")
    )


def merge_partials(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add up partial states, for instance of daily tables."""
    return partials.groupBy(*keys).agg(
        F.sum("rating_sum").alias("rating_sum"), F.sum("review_count").alias("review_count")
    )


def finish(partials: DataFrame) -> DataFrame:
    """``mean_rating`` as computed, ``avg_rating`` with the two decimals lists are ranked on."""
    keys = [c for c in partials.columns if c not in STATE]
    mean = F.col("rating_sum") / F.col("review_count")
    return (
        partials.filter(F.col("review_count") > 0)
        .withColumn("mean_rating", mean)
        .select(*keys, two_decimals(F.col("mean_rating")).alias("avg_rating"), "mean_rating", "review_count")
    )


def rating_stats(df: DataFrame, keys: Sequence[str], rating: str = "rating") -> DataFrame:
    """Mean and count per key; rows without a key or a rating do not count."""
    present = df.filter(rated(F.col(rating))).dropna(subset=list(keys))
    return finish(partial_ratings(present, keys, rating))


def product_ratings(df: DataFrame) -> DataFrame:
    """Per product; ids are trimmed, blank ones left out."""
    return rating_stats(df.withColumn("product_id", clean_key(F.col("product_id"))), ["product_id"])


def category_ratings(df: DataFrame) -> DataFrame:
    return rating_stats(df.withColumn("category", clean_key(F.col("category"))), ["category"])


def tagged_partials(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Partial state per product and per category from a single scan.

    Rows are first combined per (product, category), inside the map tasks and
    then across them. Only those combined rows are emitted twice, so the
    doubling never touches the input's row count, and both halves share one
    shuffle of the scan.
    """
    combined = partial_ratings(
        df.filter(rated(F.col("rating"))), [*by, "product_id", "category"]
    )
    return merge_partials(dual_keys(combined, carry=[*by, *STATE]), [*by, "item_type", "item_key"])


def tagged_ratings(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``item_type, item_key, avg_rating, mean_rating, review_count`` for products and categories."""
    return finish(tagged_partials(df, by))


def sample_job(df: DataFrame) -> DataFrame:
    """Mean and count per product over truthy pairs only: zero ratings are left out."""
    return rating_stats(truthy_pairs(df), ["product_id"])


def weighted_ratings(
    df: DataFrame, keys: Sequence[str], rating: str = "rating", weight: str = "rating_number"
) -> DataFrame:
    """Mean of published averages weighted by how many ratings stand behind each.

    Product metadata has one row per product; its true popularity is the sum
    of the weights, not the row count.
    """
    value, times = F.col(rating).cast("double"), F.col(weight)
    present = df.filter(rated(value) & times.isNotNull())
    return present.groupBy(*keys).agg(
        F.try_divide(F.sum(value * times), F.sum(times)).alias("weighted_rating"),
        F.sum(times).alias("rating_number"),
        F.count("*").alias("row_count"),
    )
