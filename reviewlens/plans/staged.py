"""Several datasets, each worked on by itself: a fault in one, at whatever row, stops no other.

A dataset's part of a result is a partial state (a report row, counts, a summary), written by a job of its
own. Results of all datasets are put together from the written states, so they read no input again and
meet no fault of it.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.errors import UNREADABLE, brief
from reviewlens.operators.prepare import row_sample
from reviewlens.operators.quality import rating_frequency, validation_report, value_frequency
from reviewlens.operators.ratings import finish, merge_partials, tagged_partials
from reviewlens.operators.topk import MIN_REVIEWS, TOP, top_analysis
from reviewlens.plans.analysis import from_summary, review_summary, with_combined
from reviewlens.session import written

log = logging.getLogger(__name__)

#: Name and rows of a dataset to its partial state.
State = Callable[[str, DataFrame], DataFrame]


def staged(frames: Mapping[str, DataFrame], state: State, name: str) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """The written state of every dataset that can be read to its end, and the errors of the others."""
    states, errors = {}, {}
    for dataset, df in frames.items():
        try:
            states[dataset] = written(state(dataset, df), name)
        except UNREADABLE as error:
            log.error("%s: %s", dataset, brief(error))
            errors[dataset] = brief(error)
    return states, errors


def together(states: Mapping[str, DataFrame]) -> DataFrame | None:
    """All rows of all states; nothing if there are no states."""
    if not states:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), states.values())


def alike(frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The datasets with the columns that any of them has, as a union of them would have."""
    kinds = {}
    for df in frames.values():
        for column in df.schema.fields:
            kinds.setdefault(column.name, column.dataType)
    return {
        name: df.withColumns({c: F.lit(None).cast(kind) for c, kind in kinds.items() if c not in df.columns})
        for name, df in frames.items()
    }


def validate_datasets(
    spark: SparkSession,
    frames: Mapping[str, DataFrame],
    unreadable: Mapping[str, str] | None = None,
    dataset_col: str = "dataset",
) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """``validation_report``, ``rating_frequency`` and ``category_frequency`` over datasets that carry their
    name in ``dataset_col``, and the errors by dataset.

    A dataset that cannot be read to its end, and each in ``unreadable``, has a report row with status
    Failed, no records and its error, and no part in the frequencies.
    """
    errors = dict(unreadable or {})
    frames = alike(frames)
    reports, failed = staged(frames, lambda name, df: validation_report(df, dataset_col, [name]), "validation")
    errors |= failed
    good = {name: df for name, df in frames.items() if name in reports}
    ratings, failed = staged(good, lambda _, df: rating_frequency(df, [dataset_col]), "ratings")
    errors |= failed
    results = {}
    if ratings:
        results["rating_frequency"] = together(ratings).orderBy(dataset_col, "rating")
    if any("category" in df.columns for df in good.values()):
        counts, failed = staged(good, lambda _, df: value_frequency(df, "category"), "categories")
        errors |= failed
        if counts:
            merged = together(counts).groupBy("category").agg(F.sum("count").alias("count"))
            results["category_frequency"] = merged.orderBy("category")
    rows = [(name, 0, "Failed", error) for name, error in errors.items() if name not in reports]
    faults = spark.createDataFrame(
        rows, f"{dataset_col} string, total_records bigint, validation_status string, error string"
    )
    report = together(reports)
    results["validation_report"] = faults if report is None else report.unionByName(faults, allowMissingColumns=True)
    return results, errors


def sample_datasets(
    frames: Mapping[str, DataFrame], fraction: float, rows: int | None = None
) -> tuple[DataFrame | None, dict[str, str]]:
    """``prepare.row_sample`` of all datasets that can be read to their end, and the others' errors.

    The rows are drawn by their own hashes, so drawing from each dataset first changes nothing.
    """
    drawn, errors = staged(alike(frames), lambda _, df: row_sample(df, fraction, rows=rows), "drawn")
    all_rows = together(drawn)
    if all_rows is not None and rows is not None:
        all_rows = row_sample(all_rows, fraction, rows=rows)
    return all_rows, errors


def analyze_datasets(
    frames: Mapping[str, DataFrame],
    combined: str | None = None,
    date_col: str = "timestamp",
    length_col: str = "review_length",
    rating_col: str = "rating",
    dataset_col: str = "dataset",
) -> tuple[dict[str, dict[str, DataFrame]], dict[str, str]]:
    """``plans.analysis.analyze`` over the datasets that can be read to their end, and the others' errors."""
    summaries, errors = staged(
        frames, lambda _, df: review_summary(df, [dataset_col], date_col, length_col, rating_col), "summary"
    )
    summary = together(summaries)
    if summary is None:
        return {}, errors
    if combined:
        summary = with_combined(summary, dataset_col, combined)
    return from_summary(summary, [dataset_col]), errors


def list_datasets(
    frames: Mapping[str, DataFrame],
    combined: str | None = None,
    top: int = TOP,
    min_reviews: int = MIN_REVIEWS,
    dataset_col: str = "dataset",
) -> tuple[DataFrame | None, dict[str, str]]:
    """``plans.top_lists.top_lists`` of the datasets that can be read to their end, and the others' errors."""
    by = [dataset_col]
    states, errors = staged(frames, lambda _, df: tagged_partials(df, by), "partials")
    partials = together(states)
    if partials is None:
        return None, errors
    if combined:
        partials = with_combined(partials, dataset_col, combined)
    tagged = written(finish(merge_partials(partials, [*by, "item_type", "item_key"])), "tagged")
    return top_analysis(tagged, top, min_reviews, by), errors
