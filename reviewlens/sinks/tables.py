"""Writers. Each one overwrites its target and runs as one distributed job."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, MapType, StructType

from reviewlens.errors import UNREADABLE, brief
from reviewlens.functions import finite, fixed
from reviewlens.operators.prepare import prefixed_key
from reviewlens.sinks.folders import unfit, write_parts

log = logging.getLogger(__name__)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Snappy Parquet; with ``partition_by`` readers of one dataset skip the others' files."""
    writer = df.write.mode("overwrite").option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def _finite_deep(column, data_type):
    if isinstance(data_type, (DoubleType, FloatType)):
        return finite(column)
    if isinstance(data_type, ArrayType) and _has_doubles(data_type):
        return F.transform(column, lambda x: _finite_deep(x, data_type.elementType))
    if isinstance(data_type, MapType) and _has_doubles(data_type.valueType):
        return F.transform_values(column, lambda _, x: _finite_deep(x, data_type.valueType))
    if isinstance(data_type, StructType) and _has_doubles(data_type):
        fields = [_finite_deep(column[f.name], f.dataType).alias(f.name) for f in data_type.fields]
        return F.when(column.isNotNull(), F.struct(*fields))
    return column


def _has_doubles(data_type) -> bool:
    if isinstance(data_type, ArrayType):
        return _has_doubles(data_type.elementType)
    if isinstance(data_type, MapType):
        return _has_doubles(data_type.valueType)
    if isinstance(data_type, StructType):
        return any(_has_doubles(field.dataType) for field in data_type.fields)
    return isinstance(data_type, (DoubleType, FloatType))


def json_ready(df: DataFrame) -> DataFrame:
    """NaN and the infinities have no JSON form: they become null, inside arrays, structs and map values too."""
    return df.select(*[_finite_deep(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields])


def write_json(df: DataFrame, path: str, compression: str | None = None) -> None:
    """JSON Lines with arrays as lists and nulls written out; ``gzip`` for compressed files."""
    writer = json_ready(df).write.mode("overwrite").option("ignoreNullFields", False)
    if compression:
        writer = writer.option("compression", compression)
    writer.json(path)


def write_json_or_reject(
    df: DataFrame, path: str, rejects: str, compression: str | None = "gzip"
) -> dict[str, int]:
    """JSON Lines at ``path``; rows without a JSON form at ``rejects``, with the reason, and how many of each.

    Both come from one job. A rejected row is written as JSON of ``error`` and its values as text, with
    bytes that are no UTF-8 replaced, so that it can be found again.
    """
    error = unfit(df)
    options = {"ignoreNullFields": "false"}
    texts = [F.make_valid_utf8(F.col(f"row.{c}").cast("string")).alias(c) for c in df.columns]
    rows = json_ready(df).select(error.alias("error"), F.struct("*").alias("row"))
    whole = F.to_json("row", options)
    told = F.to_json(F.struct("error", F.struct(*texts).alias("row")), options)
    lines = rows.select(
        F.when(F.col("error").isNull(), "written").otherwise("skipped").alias("part"),
        F.when(F.col("error").isNull(), whole).otherwise(told).alias("line"),
    )
    counts = write_parts(lines, {"written": path, "skipped": rejects}, compression)
    if counts["skipped"]:
        log.warning("%d of %d rows skipped, see %s", counts["skipped"], sum(counts.values()), rejects)
    return counts


def write_sample(df: DataFrame, path: str, rows: int = 1000, order: Sequence[str] | None = None) -> None:
    """The first ``rows`` rows in the order of ``order``, by default of all columns, as JSON Lines."""
    write_json(df.orderBy(*(order or df.columns)).limit(rows), path)


def delimited(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, since delimited files hold flat values only."""
    nested = (ArrayType, MapType, StructType)
    return df.select(
        *[
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def write_csv(df: DataFrame, path: str) -> None:
    delimited(df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_tsv(df: DataFrame, path: str) -> None:
    delimited(df).write.mode("overwrite").option("sep", "\t").option("header", False).csv(path)


def write_aggregate_lines(tagged: DataFrame, path: str) -> None:
    """Tagged ratings as ``key <tab> mean <tab> count`` lines, category keys prefixed."""
    lines = tagged.select(
        prefixed_key(F.col("item_type"), F.col("item_key")).alias("key"),
        fixed(F.col("avg_rating")).alias("avg_rating"),
        "review_count",
    )
    write_tsv(lines, path)


def write_if_any(df: DataFrame, write: Callable[[DataFrame], None], label: str = "result") -> int:
    """Write unless there are no rows; returns how many rows the write itself saw."""
    if df.isEmpty():
        log.warning("no rows for %s, nothing written", label)
        return 0
    seen = Observation(label)
    write(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return seen.get["n"]


def write_results(results: Mapping[str, DataFrame], folder: str) -> None:
    """One JSON folder per result frame, named after it."""
    for name, df in results.items():
        write_json(df, f"{folder}/{name}_json")


FORMATS: dict[str, Callable[[DataFrame, str], None]] = {"json": write_json, "csv": write_csv}


def export(
    spark: SparkSession,
    inputs: Mapping[str, str],
    folder: str,
    formats: Mapping[str, Callable[[DataFrame, str], None]] | None = None,
) -> dict[str, str]:
    """Each Parquet dataset in every format, at ``<folder>/<dataset>_<format>``.

    Missing inputs are skipped, and one that fails does not stop the others.
    Returns the outcome per output: its path, ``missing``, or the error.
    """
    outcome = {}
    for name, path in inputs.items():
        try:
            df = spark.read.parquet(path)
        except UNREADABLE as error:
            log.warning("%s skipped: %s", name, brief(error))
            outcome[name] = "missing" if isinstance(error, AnalysisException) else f"error: {brief(error)}"
            continue
        for suffix, write in (formats or FORMATS).items():
            target = f"{folder}/{name}_{suffix}"
            try:
                write(df, target)
                outcome[f"{name}_{suffix}"] = target
            except UNREADABLE as error:
                log.warning("%s as %s failed: %s", name, suffix, brief(error))
                outcome[f"{name}_{suffix}"] = f"error: {brief(error)}"
    return outcome
