"""Distribution of ratings: summary statistics, histogram, stars.

The input is reduced to one row per band of ratings first, inside the map tasks and then across them. A
band holds one value on any scale of up to three significant digits, and there is a bounded number of
bands whatever the values; everything else follows from those rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.functions import band, half_step, percent, rated, star
from reviewlens.operators.quantiles import QUARTILES, banded_quantiles, exact_quantiles

# Deviations are taken from a point inside the rating scale: squares of large
# offsets would drown the spread.
CENTRE = 3.0


def band_measures(rating: str = "rating", centre: float = CENTRE) -> list[Column]:
    """Aggregates over rows with a rating that make up the state of a band."""
    deviation = F.col(rating) - F.lit(centre)
    return [
        F.count("*").alias("count"),
        F.min(rating).alias("low"),
        F.max(rating).alias("high"),
        F.sum(deviation).alias("deviation"),
        F.sum(deviation * deviation).alias("squares"),
    ]


def rating_counts(df: DataFrame, rating: str = "rating", by: Sequence[str] = (), centre: float = CENTRE) -> DataFrame:
    """The state of every band with ratings: band, count, low, high, deviation, squares."""
    # adding zero makes one value of both zeros
    present = df.filter(rated(F.col(rating))).select(*by, (F.col(rating).cast("double") + F.lit(0.0)).alias("rating"))
    return present.groupBy(*by, band(F.col("rating")).alias("band")).agg(*band_measures("rating", centre))


def merged_bands(bands: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """States of equal bands added up: coarser groups, or several parts of one table."""
    return bands.groupBy(*by, "band").agg(
        F.sum("count").alias("count"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.sum("deviation").alias("deviation"),
        F.sum("squares").alias("squares"),
    )


_STATS = ["count", "min", "q1", "median", "q3", "max", "mean", "stddev", "variance", "iqr"]


def _finished(sums: DataFrame, by: Sequence[str], centre: float) -> DataFrame:
    """Mean and spread from the sums of deviations, next to the quartiles; groups without ratings are left out."""
    n = F.col("count")
    spread = F.col("squares") - F.col("deviation") * F.col("deviation") / n
    return (
        sums.filter(n.isNotNull())
        .withColumn("mean", F.lit(centre) + F.col("deviation") / n)
        .withColumn("variance", F.try_divide(F.greatest(spread, F.lit(0.0)), n - 1))
        .withColumn("stddev", F.sqrt("variance"))
        .withColumn("iqr", F.col("q3") - F.col("q1"))
        .select(*by, *_STATS)
    )


def _moments() -> list[Column]:
    return [
        F.sum("count").alias("count"),
        F.min("low").alias("min"),
        F.max("high").alias("max"),
        F.sum("deviation").alias("deviation"),
        F.sum("squares").alias("squares"),
    ]


def basic_stats(counts: DataFrame, by: Sequence[str] = (), centre: float = CENTRE) -> DataFrame:
    """One row per group from the state of ``rating_counts``: count, five-number summary, mean, spread.

    Quartiles are exact on scales of up to three significant digits, else within one part in 8192 of the
    value (see ``banded_quantiles``); all else is exact. ``exact_stats`` has exact quartiles of anything.
    """
    return _finished(banded_quantiles(counts, by=by, others=_moments()), by, centre)


def exact_stats(df: DataFrame, rating: str = "rating", by: Sequence[str] = (), centre: float = CENTRE) -> DataFrame:
    """The same row with exact quartiles, whatever the values; rounds of counting run at once."""
    moments = rating_counts(df, rating, by, centre).groupBy(*by).agg(*_moments())
    both = moments.unionByName(exact_quantiles(df, by=by, value=rating), allowMissingColumns=True)
    one = both.groupBy(*by).agg(*[F.max(c).alias(c) for c in both.columns if c not in by])
    return _finished(one, by, centre)


def approx_stats(
    df: DataFrame, rating: str = "rating", by: Sequence[str] = (), accuracy: int = 10_000
) -> DataFrame:
    """The same row straight from the input, with quartiles from a sketch of fixed size."""
    sketch = F.percentile_approx(rating, list(QUARTILES.values()), accuracy)
    row = df.groupBy(*by).agg(
        F.count(rating).alias("count"),
        F.min(rating).alias("min"),
        F.max(rating).alias("max"),
        F.avg(rating).alias("mean"),
        F.stddev_samp(rating).alias("stddev"),
        F.var_samp(rating).alias("variance"),
        sketch.alias("_q"),
    )
    return (
        row.withColumns({name: F.col("_q")[i] for i, name in enumerate(QUARTILES)})
        .withColumn("iqr", F.col("q3") - F.col("q1"))
        .drop("_q")
    )


def _distribution(counts: DataFrame, bucket: Column, name: str, by: Sequence[str]) -> DataFrame:
    grouped = counts.groupBy(*by, bucket.alias(name)).agg(F.sum("count").alias("count"))
    total = F.sum("count").over(Window.partitionBy(*by))
    return grouped.withColumn("percentage", percent(F.col("count"), total))


def histogram(counts: DataFrame, by: Sequence[str] = (), width: float = 0.5) -> DataFrame:
    return _distribution(counts, half_step(F.col("low"), width), "rating_bucket", by)


def star_distribution(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return _distribution(counts, star(F.col("low")), "star_rating", by)


def rating_distribution(
    df: DataFrame, rating: str = "rating", by: Sequence[str] = ()
) -> dict[str, DataFrame]:
    counts = rating_counts(df, rating, by)
    return {
        "histogram": histogram(counts, by),
        "star_distribution": star_distribution(counts, by),
        "basic_stats": basic_stats(counts, by),
    }
