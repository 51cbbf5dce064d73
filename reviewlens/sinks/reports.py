"""Text reports: top lists, statistics, correlation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions import fixed
from reviewlens.operators.topk import SECTIONS

# Titles of the statistics report and its labels in order.
STATS_TITLE = "Ratings Distribution Statistics"
STATS_LABELS = {
    "count": "Count",
    "min": "Minimum",
    "max": "Maximum",
    "mean": "Mean",
    "stddev": "Standard Deviation",
    "median": "Median",
    "q1": "25th Percentile",
    "q3": "75th Percentile",
    "iqr": "Interquartile Range",
}
CORRELATION_LABEL = "Correlation between review length and rating"


def report_lines(top: DataFrame) -> DataFrame:
    """Top analysis as numbered text lines: titled sections with a blank line between.

    Titles and blank lines are there for empty sections too.
    """
    spark = top.sparkSession
    frame = []
    for number, title in enumerate(SECTIONS, 1):
        frame.append((number, 0, title))
        if number < len(SECTIONS):
            frame.append((number, 2**31 - 1, ""))
    fixed_lines = spark.createDataFrame(frame, "section_no int, line_no int, value string")
    rows = top.select(
        "section_no",
        F.col("rank").alias("line_no"),
        F.concat_ws(
            "\t",
            F.col("rank").cast("string"),
            "item_key",
            fixed(F.col("avg_rating"), 2, ""),
            F.col("review_count").cast("string"),
        ).alias("value"),
    )
    return rows.unionByName(fixed_lines)


def stats_lines(basic_stats: DataFrame) -> DataFrame:
    """Statistics report: title, rule, one labelled line per measure."""
    lines = [F.lit(STATS_TITLE), F.lit("=" * 30)]
    for name, label in STATS_LABELS.items():
        value = F.col(name).cast("string") if name == "count" else fixed(F.col(name), 2, "undefined")
        lines.append(F.concat(F.lit(f"{label}: "), value))
    return basic_stats.select(F.posexplode(F.array(*lines)).alias("line_no", "value"))


def correlation_line(correlation: DataFrame) -> DataFrame:
    value = fixed(F.col("correlation"), 4, "undefined")
    return correlation.select(
        F.lit(0).alias("line_no"), F.concat(F.lit(f"{CORRELATION_LABEL}: "), value).alias("value")
    )


def write_lines(lines: DataFrame, path: str) -> None:
    """A report as text in line order.

    A short report is one file; a long one spans several, whose names sort in
    the order of its lines.
    """
    order = [c for c in lines.columns if c != "value"]
    lines.orderBy(*order).select("value").write.mode("overwrite").text(path)
