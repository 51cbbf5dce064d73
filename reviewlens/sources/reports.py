"""Reader for the sectioned top-list report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewlens.operators.topk import SECTIONS


def read_report(spark: SparkSession, path: str, sections: list[str] | None = None) -> DataFrame:
    """Ranked rows of a report with the section each one stands in.

    A line belongs to the last title above it in its folder, whose files are
    taken in name order. Titles are few: they become spans of line positions,
    to which each line is matched where it is read. Only lines that start with
    a digit and have the fields of a ranked row count; without the fourth the count is null.
    """
    meta = F.col("_metadata")
    position = F.struct(meta["file_name"], meta["file_block_start"], F.monotonically_increasing_id())
    lines = spark.read.text(path).select(
        F.regexp_extract(meta["file_path"], "^(.*)/", 1).alias("folder"),
        position.alias("position"),
        F.btrim("value", F.lit("\r")).alias("line"),
    )
    in_order = Window.partitionBy("folder").orderBy("start")
    spans = (
        lines.filter(F.btrim("line").isin(*SECTIONS))
        .select("folder", F.btrim("line").alias("section"), F.col("position").alias("start"))
        .withColumn("end", F.lead("start").over(in_order))
    )
    if sections:
        spans = spans.filter(F.col("section").isin(*sections))
    fields = F.split("line", "\t")
    rows = lines.filter(F.col("line").rlike(r"^[0-9]") & (F.size(fields) >= 3))
    inside = (F.col("position") > F.col("start")) & (
        F.col("end").isNull() | (F.col("position") < F.col("end"))
    )
    return rows.join(spans, "folder").filter(inside).select(
        "section",
        fields[0].try_cast("int").alias("rank"),
        fields[1].alias("item_key"),
        fields[2].try_cast("double").alias("avg_rating"),
        F.get(fields, F.lit(3)).try_cast("bigint").alias("review_count"),
    )
