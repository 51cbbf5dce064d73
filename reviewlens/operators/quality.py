"""Data-quality profiles, each from one aggregate over one scan."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from reviewlens.functions import percent

OUTLIER_LENGTH = 10_000


def _missing(columns: Sequence[str]) -> Column:
    """Array of (column, missing_count, missing_pct) built inside an aggregate."""
    return F.array(
        *[
            F.struct(
                F.lit(name).alias("column"),
                F.count_if(F.col(name).isNull()).alias("missing_count"),
                percent(F.count_if(F.col(name).isNull()), F.count(F.lit(1))).alias("missing_pct"),
            )
            for name in columns
        ]
    )


def missing_profile(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Null count and share of every column, one row per column."""
    columns = [c for c in df.columns if c not in by]
    return df.groupBy(*by).agg(_missing(columns).alias("missing")).select(*by, F.inline("missing"))


def value_frequency(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per distinct value, in value order."""
    return df.groupBy(*by, column).agg(F.count("*").alias("count")).orderBy(*by, column)


def rating_frequency(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return value_frequency(df, "rating", by)


def category_frequency(df: DataFrame) -> DataFrame:
    return value_frequency(df, "category")


def _summary(column: str, suffix: str) -> list[Column]:
    return [
        F.min(column).alias(f"min_{suffix}"),
        F.max(column).alias(f"max_{suffix}"),
        F.avg(column).alias(f"avg_{suffix}"),
        F.stddev_samp(column).alias(f"stddev_{suffix}"),
    ]


def rating_summary(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*_summary("rating", "rating"))


def length_summary(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*_summary("review_length", "length"))


def _outliers(limit: int) -> list[Column]:
    long = F.count_if(F.col("review_length") > limit)
    return [long.alias("outlier_count"), percent(long, F.count(F.lit(1))).alias("outlier_pct")]


def outlier_share(df: DataFrame, limit: int = OUTLIER_LENGTH, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*_outliers(limit))


def row_counts(df: DataFrame, by: Sequence[str] = ("dataset",)) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("row_count"))


def validation_report(
    df: DataFrame,
    dataset_col: str = "dataset",
    expected: Sequence[str] | None = None,
    outlier_length: int = OUTLIER_LENGTH,
) -> DataFrame:
    """One row per dataset: totals, missing values, rating and length statistics, status.

    All of it is one aggregate over one scan. A dataset named in ``expected``
    without any row is reported as failed; one that is not named is reported too.
    """
    columns = [c for c in df.columns if c != dataset_col]
    measures = [
        F.count(F.lit(1)).alias("total_records"),
        _missing(columns).alias("missing"),
        *_summary("rating", "rating"),
    ]
    if "review_length" in columns:
        measures += [*_summary("review_length", "length"), *_outliers(outlier_length)]
    report = df.groupBy(dataset_col).agg(*measures)
    if expected is not None:
        names = df.sparkSession.createDataFrame([(n,) for n in expected], f"{dataset_col} string")
        report = names.join(report, dataset_col, "full").fillna(0, ["total_records"])
    status = F.when(F.col("total_records") > 0, "Passed").otherwise("Failed")
    return report.withColumn("validation_status", status)


def validation_rollup(report: DataFrame) -> DataFrame:
    """How many datasets were validated, passed and failed."""
    passed = F.col("validation_status") == "Passed"
    return report.agg(
        F.count("*").alias("datasets"),
        F.count_if(passed).alias("success_count"),
        F.count_if(~passed).alias("failed_count"),
        F.sum("total_records").alias("total_records"),
    )


def step_counts(
    df: DataFrame,
    step: Callable[[DataFrame], DataFrame],
    sink: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """Rows before and after a step, counted while the step's output is written.

    Both counts ride on the one job that the write runs anyway. Without a
    ``sink`` the output is computed and thrown away.
    """
    before, after = Observation("rows_before"), Observation("rows_after")
    watched = step(df.observe(before, F.count(F.lit(1)).alias("n"))).observe(
        after, F.count(F.lit(1)).alias("n")
    )
    if sink is None:
        watched.write.format("noop").mode("overwrite").save()
    else:
        sink(watched)
    initial, final = before.get["n"], after.get["n"]
    return df.sparkSession.createDataFrame(
        [(initial, final, initial - final)],
        "initial_count bigint, final_count bigint, removed_count bigint",
    )
