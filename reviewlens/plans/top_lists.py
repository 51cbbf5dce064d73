"""Two-stage top analysis, and the report that brings all results together."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.operators.ratings import finish, merge_partials, tagged_partials, tagged_ratings
from reviewlens.operators.topk import MIN_REVIEWS, TOP, top_analysis
from reviewlens.plans.analysis import with_combined
from reviewlens.session import written
from reviewlens.sinks import report_lines, write_aggregate_lines, write_lines


def top_lists(
    df: DataFrame,
    top: int = TOP,
    min_reviews: int = MIN_REVIEWS,
    by: Sequence[str] = (),
    combined: str | None = None,
) -> DataFrame:
    """Ratings to ranked lists; ``by`` gives one set of lists per dataset.

    The aggregated ratings, a row per product and category, are written once; the reviews are read once.

    ``combined`` adds the lists of all datasets together, under that name in the first ``by`` column,
    from the same partial sums.
    """
    if not combined:
        return top_analysis(written(tagged_ratings(df, by), "tagged"), top, min_reviews, by)
    if not by:
        raise ValueError("combined lists need a dataset column")
    partials = with_combined(tagged_partials(df, by), by[0], combined)
    tagged = written(finish(merge_partials(partials, [*by, "item_type", "item_key"])), "tagged")
    return top_analysis(tagged, top, min_reviews, by)


def top_job(
    df: DataFrame, folder: str, top: int = TOP, min_reviews: int = MIN_REVIEWS
) -> DataFrame:
    """Both stages with their outputs kept: aggregate lines, then the report text.

    The aggregated ratings are written once and both outputs read that table; the lists are written once
    too, for the report and the caller.
    """
    tagged = written(tagged_ratings(df), "tagged")
    write_aggregate_lines(tagged, f"{folder}/aggregates")
    lists = written(top_analysis(tagged, top, min_reviews), "lists")
    write_lines(report_lines(lists), f"{folder}/report")
    return lists


def integrated_report(
    lists: DataFrame,
    results: Mapping[str, Mapping[str, DataFrame]],
    dataset_col: str = "dataset",
) -> DataFrame:
    """Top lists, statistics and correlation of all datasets as long rows.

    ``analysis`` and ``measure`` name the value; ``rank`` and ``item`` are set in lists, where each item
    has its mean and its count.
    """
    ranked = lists.select(
        dataset_col,
        F.lower("section").alias("analysis"),
        "rank",
        F.col("item_key").alias("item"),
        F.inline(
            F.array(
                F.struct(F.lit("mean").alias("measure"), F.col("avg_rating").alias("value")),
                F.struct(F.lit("count").alias("measure"), F.col("review_count").cast("double").alias("value")),
            )
        ),
    )
    nothing = [F.lit(None).cast("int").alias("rank"), F.lit(None).cast("string").alias("item")]
    measures = ["count", "min", "q1", "median", "q3", "max", "mean", "stddev", "variance", "iqr"]
    stats = results["stats"]["basic_stats"]
    stats = stats.select(dataset_col, *[F.col(m).cast("double") for m in measures])
    stats = stats.unpivot([dataset_col], measures, "measure", "value").select(
        dataset_col, F.lit("basic_stats").alias("analysis"), *nothing, "measure", "value"
    )
    correlation = results["bias"]["correlation"].select(
        dataset_col,
        F.lit("bias").alias("analysis"),
        *nothing,
        F.lit("correlation").alias("measure"),
        F.col("correlation").alias("value"),
    )
    return ranked.unionByName(stats).unionByName(correlation)
