"""What lies in a folder: file inventory, JSON format profile, dataset inventory."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.errors import UNREADABLE, brief
from reviewlens.functions import decoded, megabytes, name_from_path
from reviewlens.session import written
from reviewlens.sources.json_values import whole_values


def file_inventory(
    spark: SparkSession, path: str, expected: Sequence[str] | None = None
) -> DataFrame:
    """Name, size and time of each file; with ``expected`` also which names are missing.

    Only file status is read: the content column is pruned from the scan.
    """
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select(
            name_from_path(F.col("path"), 0).alias("name"),
            F.col("path"),
            F.col("length").alias("bytes"),
            megabytes(F.col("length")).alias("megabytes"),
            F.col("modificationTime").alias("modified"),
        )
    )
    if expected is None:
        return found
    names = spark.createDataFrame([(name,) for name in expected], "name string")
    return names.join(found, "name", "left").withColumn("present", F.col("path").isNotNull())


_BLANKS = " \t\r\n\ufeff"


def _is_json(value: Column) -> Column:
    """Whether a trimmed text is one JSON value; parsing alone does not look at what follows the value."""
    ends = value.rlike(r'(?s)^(?:\{.*\}|\[.*\]|"(?:[^"\\]|\\.)*+"|-?[0-9][0-9.eE+-]*|true|false|null)$')
    return F.try_parse_json(value).isNotNull() & ends


def json_profile(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Per file: format, bytes, lines by kind, the first record's fields, items of arrays.

    ``format`` is ``lines`` for JSON Lines, and ``array`` or ``object`` for a file that is one value over many
    lines; ``invalid`` if it begins like one, is none, and has no record. Files are read line by line, so one of
    any size spreads over many tasks. Those whose first line is no JSON by itself but opens an array or an
    object, and most of whose lines are no records, are read again, by stretches too (``json_values``).
    """
    meta = F.col("_metadata")
    lines = (
        spark.read.text(path)
        .select(
            meta["file_path"].alias("path"),
            meta["file_size"].alias("bytes"),
            F.struct(meta["file_block_start"], F.monotonically_increasing_id()).alias("position"),
            F.btrim("value", F.lit(_BLANKS)).alias("value"),
        )
        .filter(F.length("value") > 0)
        .withColumn("valid", _is_json(F.col("value")))
        .withColumn("keys", F.when(F.col("valid"), F.json_object_keys("value")))
        .withColumn("items", F.when(F.col("valid"), F.json_array_length("value")))
    )
    record = F.col("keys").isNotNull()
    opening = ~F.col("valid") & F.substring("value", 1, 1).isin("[", "{")
    by_line = written(
        lines.groupBy("path").agg(
            F.max("bytes").alias("bytes"),
            F.count("*").alias("line_count"),
            F.count_if(record).alias("object_lines"),
            F.count_if(F.col("items").isNotNull()).alias("array_lines"),
            F.count_if(~F.col("valid")).alias("invalid_lines"),
            F.min_by(F.when(record, F.col("keys")), F.when(record, F.col("position"))).alias("first_keys"),
            F.sum("items").alias("array_items"),
            F.min_by(opening, "position").alias("opens"),
        ),
        "profile",
    )
    by_line = by_line.withColumn("file", decoded(F.col("path")))
    # names of files, which the scan's listing has on the driver anyway
    opens = F.col("opens") & (2 * F.col("object_lines") < F.col("line_count"))
    whole = [r["file"] for r in by_line.filter(opens).select("file").toLocalIterator()]
    shown = ["file", "format", "bytes", "line_count", "object_lines", "array_lines", "invalid_lines", "first_keys", "array_items"]
    if not whole:
        return by_line.withColumn("format", F.lit("lines")).select(*shown)
    value = whole_values(spark, [_literal(name) for name in whole]).withColumn("valid", F.lit(True))
    both = by_line.join(value, "path", "left")
    one = F.coalesce(F.col("valid"), F.lit(False))
    kind = F.when(one & F.col("whole_items").isNotNull(), "array").when(one, "object")
    kind = F.coalesce(kind, F.when(opens & (F.col("object_lines") == 0), "invalid"), F.lit("lines"))
    none = {name: F.when(one, F.lit(0).cast("bigint")).otherwise(F.col(name)) for name in ("object_lines", "array_lines", "invalid_lines")}
    return both.withColumns(
        {
            "format": kind,
            **none,
            "first_keys": F.when(one, F.col("whole_keys")).otherwise(F.col("first_keys")),
            "array_items": F.when(one, F.col("whole_items")).otherwise(F.col("array_items")),
        }
    ).select(*shown)


def _literal(path: str) -> str:
    """A path in which no character stands for others."""
    return re.sub(r"([*?{}\[\]\\])", r"\\\1", path)


def dataset_inventory(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Per expected dataset: can it be read to its end, how many rows, and if not, why.

    One count per dataset comes to the driver; a fault met while counting is that dataset's own.
    """
    rows = []
    for name, path in paths.items():
        try:
            rows.append((name, True, spark.read.parquet(path).count(), None))
        except UNREADABLE as failure:
            rows.append((name, False, None, brief(failure)))
    return spark.createDataFrame(rows, "dataset string, readable boolean, row_count bigint, error string")


def preview(df: DataFrame, rows: int = 2, order: Sequence[str] | None = None) -> DataFrame:
    """The first rows of a frame in the order of ``order``, by default of all its columns."""
    return df.orderBy(*(order or df.columns)).limit(rows)
