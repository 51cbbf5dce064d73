"""Analysis bundles over one dataset, several, or all combined.

The bundle reads the reviews once, into a summary with a row per (dataset,
month, length bucket, band of ratings) that is written to the shared folder.
Trends, bias and distribution results of every dataset, and of all combined,
derive from that table. Bands are bounded in number, so it stays small whatever
the input's size and however many distinct ratings there are.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions import LENGTH_EDGES, LENGTH_LABELS, band, length_bucket, rated, star
from reviewlens.operators import bias, stats, trends
from reviewlens.operators.ratings import merge_partials
from reviewlens.session import written
from reviewlens.sinks import correlation_line, stats_lines, write_lines, write_results

log = logging.getLogger(__name__)

COMBINED = "all_categories"

# Lengths enter the correlation as deviations from a typical length.
LENGTH_CENTRE = 500


def review_summary(
    df: DataFrame,
    by: Sequence[str] = (),
    date_col: str = "timestamp",
    length_col: str = "review_length",
    rating_col: str = "rating",
    edges: Sequence[int] = LENGTH_EDGES,
    labels: Sequence[str] = LENGTH_LABELS,
) -> DataFrame:
    """Partial state at the grain that all results share; ``stats.band_measures`` and lengths per band."""
    deviation = (F.col(length_col) - F.lit(LENGTH_CENTRE)).cast("double")
    present = df.filter(rated(F.col(rating_col))).select(
        *by,
        F.year(date_col).alias("year"),
        F.month(date_col).alias("month"),
        length_bucket(F.col(length_col), edges, labels).alias("length_bucket"),
        (F.col(rating_col).cast("double") + F.lit(0.0)).alias("rating"),
        F.col(length_col).alias("length"),
        deviation.alias("length_deviation"),
    )
    banded = present.groupBy(*by, "year", "month", "length_bucket", band(F.col("rating")).alias("band"))
    return banded.agg(
        F.sum("rating").alias("rating_sum"),
        F.count("*").alias("review_count"),
        *stats.band_measures("rating"),
        F.min("length").alias("min_length"),
        F.max("length").alias("max_length"),
        F.sum("length_deviation").alias("length_deviation"),
        F.sum(F.col("length_deviation") * F.col("length_deviation")).alias("length_squares"),
        F.sum((F.col("rating") - F.lit(stats.CENTRE)) * F.col("length_deviation")).alias("shared"),
    )


def with_combined(summary: DataFrame, dataset_col: str, name: str = COMBINED) -> DataFrame:
    """Every summary row a second time under the name of the combined dataset."""
    both = F.explode(F.array(F.col(dataset_col), F.lit(name))).alias(dataset_col)
    return summary.select(both, *[c for c in summary.columns if c != dataset_col])


def summary_correlation(summary: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation of length and rating; null where either is constant."""
    n = F.col("n")
    sums = (
        summary.filter(F.col("length_bucket").isNotNull())
        .groupBy(*by)
        .agg(
            F.sum("review_count").alias("n"),
            F.sum("length_deviation").alias("x"),
            F.sum("length_squares").alias("xx"),
            F.sum("deviation").alias("y"),
            F.sum("squares").alias("yy"),
            F.sum("shared").alias("xy"),
            ((F.min("min_length") < F.max("max_length")) & (F.min("low") < F.max("high"))).alias("varied"),
        )
    )
    spread_x = F.col("xx") - F.col("x") * F.col("x") / n
    spread_y = F.col("yy") - F.col("y") * F.col("y") / n
    shared = F.col("xy") - F.col("x") * F.col("y") / n
    correlation = F.when(F.col("varied"), F.try_divide(shared, F.sqrt(spread_x) * F.sqrt(spread_y)))
    return sums.select(*by, correlation.alias("correlation"))


def from_summary(summary: DataFrame, by: Sequence[str] = ()) -> dict[str, dict[str, DataFrame]]:
    months = merge_partials(summary.filter(F.col("year").isNotNull()), [*by, "year", "month"])
    lengths = merge_partials(
        summary.filter(F.col("length_bucket").isNotNull()).withColumn(
            "rating_rounded", star(F.col("low"))  # no band reaches over a half
        ),
        [*by, "length_bucket", "rating_rounded"],
    )
    counts = stats.merged_bands(summary, by)
    return {
        "trends": {
            "monthly": trends.monthly(months),
            "yearly": trends.yearly(months, by),
            "rolling": trends.rolling(months, by),
        },
        "bias": {
            "bucket_stats": bias.bucket_stats(lengths, by),
            "rating_pivot": bias.rating_pivot(lengths, by),
            "correlation": summary_correlation(summary, by),
        },
        "stats": {
            "histogram": stats.histogram(counts, by),
            "star_distribution": stats.star_distribution(counts, by),
            "basic_stats": stats.basic_stats(counts, by),
        },
    }


def analyze(
    df: DataFrame,
    dataset_col: str | None = None,
    combined: str | None = None,
    date_col: str = "timestamp",
    length_col: str = "review_length",
    rating_col: str = "rating",
) -> dict[str, dict[str, DataFrame]]:
    """Trend, bias and distribution results, keyed by analysis and result name.

    With ``dataset_col`` every frame has rows per dataset; ``combined`` adds
    those of all datasets together under that name.
    """
    if combined and not dataset_col:
        raise ValueError("a combined result needs a dataset column")
    by = [dataset_col] if dataset_col else []
    summary = written(review_summary(df, by, date_col, length_col, rating_col), "summary")
    if combined:
        summary = with_combined(summary, dataset_col, combined)
    return from_summary(summary, by)


def save_analysis(
    results: Mapping[str, Mapping[str, DataFrame]],
    folder: str,
    dataset: str | None = None,
    dataset_col: str = "dataset",
) -> dict[str, str]:
    """Write each analysis below ``folder``; one that fails does not stop the others.

    ``dataset`` picks one dataset's rows out of grouped results, by the column
    ``dataset_col``. Returns the errors by analysis.
    """
    errors = {}
    for analysis, frames in results.items():
        target = f"{folder}/{analysis}"
        try:
            chosen = {
                name: df.filter(F.col(dataset_col) == dataset).drop(dataset_col) if dataset else df
                for name, df in frames.items()
            }
            write_results(chosen, target)
            if "basic_stats" in chosen:
                write_lines(stats_lines(chosen["basic_stats"]), f"{target}/basic_stats_summary")
            if "correlation" in chosen:
                write_lines(correlation_line(chosen["correlation"]), f"{target}/correlation")
        except Exception as error:  # an analysis is a unit of its own
            log.exception("%s failed", analysis)
            errors[analysis] = str(error).splitlines()[0]
    return errors
