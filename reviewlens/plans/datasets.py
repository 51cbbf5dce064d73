"""Preprocess, prepare and combine datasets."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewlens.errors import UNREADABLE, brief
from reviewlens.functions import slug
from reviewlens.operators.prepare import (
    MissingColumns,
    Taken,
    harmonise,
    length_parts,
    pair_parts,
    time_parts,
)
from reviewlens.sinks import replace, write_parquet, write_parts
from reviewlens.sources import read_raw_once, read_raw_products

log = logging.getLogger(__name__)

# The extracts and the suffix their folders carry.
EXTRACTS: dict[str, Callable[[DataFrame], Taken]] = {
    "product_ratings": pair_parts,
    "time_analysis": time_parts,
    "review_length": length_parts,
}


def union_all(frames: Mapping[str, DataFrame], dataset_col: str | None = "dataset") -> DataFrame:
    """All rows of all datasets, by column name, with the dataset each came from.

    Pass leaf datasets only: a table that already combines others would count
    their rows twice.
    """
    if not frames:
        raise ValueError("no dataset to combine")
    named = frames.values()
    if dataset_col:
        named = [df.withColumn(dataset_col, F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def union_if_complete(
    frames: Mapping[str, DataFrame], expected: list[str], dataset_col: str | None = "dataset"
) -> DataFrame | None:
    """The union, or nothing unless every expected dataset is there."""
    absent = [name for name in expected if name not in frames]
    if absent:
        log.warning("not combined, missing: %s", ", ".join(absent))
        return None
    return union_all({name: frames[name] for name in expected}, dataset_col)


def preprocess(
    spark: SparkSession,
    inputs: Mapping[str, str],
    output: str,
    partitions: int | None = None,
    schemas: Mapping[str, StructType] | None = None,
) -> dict[str, str]:
    """Raw JSON datasets to one processed Parquet table with a folder per dataset.

    The combined table is the union of the folders, not a second pass. Each
    dataset is written once, aside, and renamed into its place: one that cannot
    be read, at whatever row the fault lies, stops no other and leaves what an
    earlier run wrote as it is. ``schemas`` names the fields of datasets whose
    fields are known; without it they are noted while the JSON is read.
    Returns the error of each dataset that was not written.
    """
    errors = {}
    named = spark.createDataFrame([(name,) for name in inputs], "name string")
    folders = {r["name"]: f"{output}/dataset={r['slug']}" for r in named.select("name", slug(F.col("name")).alias("slug")).collect()}
    for name, path in inputs.items():
        folder = folders[name]
        try:
            # The harmonised rows keep the dataset's raw name as their category.
            if name in (schemas or {}):
                raw = read_raw_products(spark, path, name, schemas[name], partitions)
            else:
                raw = read_raw_once(spark, path, name, partitions)
            rows = harmonise(raw)
            replace(rows, folder, write_parquet)
        except UNREADABLE as error:
            log.error("%s: %s", name, brief(error))
            errors[name] = brief(error)
    return errors


def prepare(df: DataFrame, folder: str) -> dict[str, int]:
    """The three extracts of a processed dataset as headerless TSV; rows written per extract.

    One scan of the table feeds all of them: a row gives a line for each extract that takes it, and lines
    go to their extract's files. An extract whose columns are missing, or that has no rows, is left out.
    """
    lines, counts = [], dict.fromkeys(EXTRACTS, 0)
    for name, taken in EXTRACTS.items():
        try:
            columns, keep = taken(df)
        except MissingColumns as error:
            log.error("%s: %s", name, error)
            continue
        line = F.to_csv(F.struct(*columns), {"sep": "\t"})
        lines.append(F.struct(F.lit(name).alias("part"), F.when(keep, line).alias("line")))
    if lines:
        rows = df.select(F.inline(F.array(*lines))).filter(F.col("line").isNotNull())
        counts |= write_parts(rows, {name: f"{folder}_{name}" for name in counts})
    return counts
