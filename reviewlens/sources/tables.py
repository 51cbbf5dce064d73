"""Readers for product metadata, processed tables, rating pairs and review events."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from reviewlens.errors import UNREADABLE, brief
from reviewlens.functions import decoded, is_rating, name_from_path, one_line, parse_rating
from reviewlens.operators.prepare import ORIGINS, with_category
from reviewlens.schemas import AGGREGATE_LINE, EVENT_TEXT, PROCESSED, RATING_PAIR, RAW_FIELDS
from reviewlens.session import written
from reviewlens.sinks import current

_CORRUPT = "_corrupt_record"


def read_raw_products(
    spark: SparkSession,
    path: str | list[str],
    category: str,
    schema: StructType | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """JSON Lines (gz or plain) with a ``category`` column added where it is absent.

    Which columns a dataset has decides where its ids and ratings come from.
    Give a ``raw_schema`` of the fields the data has; without one they are
    inferred, at the price of a pass over the data, all fields included.
    ``read_raw_once`` notes the known fields in the pass that reads them. One gz file is
    one task whatever its size, so ``partitions`` spreads the rows before the
    work that follows.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = with_category(reader.json(path), category)
    return df.repartition(partitions) if partitions else df


#: Fields of raw records that anything is made of.
_RAW_NAMES = list(
    dict.fromkeys([*RAW_FIELDS.fieldNames(), *PROCESSED.fieldNames(), *(n for names in ORIGINS.values() for n in names)])
)


def _raw_column(record: Column, name: str) -> Column:
    """A field of a VARIANT record in the type its processed column has; what does not fit it is null."""
    target = next((to for to, origins in ORIGINS.items() if name in origins), name)
    kind = PROCESSED[target].dataType if target in PROCESSED.names else StringType()
    path = f"$.{name}"
    if kind != StringType():
        return F.try_variant_get(record, path, kind.simpleString())
    # elements that are null are skipped; objects and nested arrays come as JSON
    words = F.array_join(F.try_variant_get(record, path, "array<string>"), " ")
    return F.coalesce(words, F.try_variant_get(record, path, "string"))


def read_raw_once(spark: SparkSession, path: str | list[str], category: str, partitions: int | None = None) -> DataFrame:
    """Raw metadata of any shape as ``read_raw_products`` gives it, from one pass over the JSON.

    Each line is parsed once, into a VARIANT; the fields that a processed table can be made of are taken out
    in its types and written as columns, and the same job notes which of them occur at all. Columns that
    never do are left out, so that origins are settled over the written table. A field may have another
    type in every record. A line that is no JSON object is a row of nulls; empty lines are skipped.
    """
    lines = spark.read.text(path).filter(F.length(F.btrim("value")) > 0)
    if partitions:
        lines = lines.repartition(partitions)
    records = lines.select(F.try_parse_json("value").alias("record"))
    there = {n: F.try_variant_get("record", f"$.{n}", "variant").isNotNull() for n in _RAW_NAMES}
    seen = Observation("fields")
    watched = records.observe(seen, *[F.count_if(test).alias(name) for name, test in there.items()])
    table = written(watched.select(*[_raw_column(F.col("record"), n).alias(n) for n in _RAW_NAMES]), "raw")
    found = [name for name in _RAW_NAMES if seen.get[name]]
    if not found:  # rows without any field that is known
        return with_category(table.select(F.lit(None).cast("string").alias("title")), category)
    return with_category(table.select(*found), category)


def read_processed(
    spark: SparkSession, paths: Mapping[str, str], dataset_col: str = "dataset"
) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Processed Parquet tables by dataset, and the error of each that cannot be opened.

    A table whose replacement was cut off is read in its last whole version.
    """
    frames, errors = {}, {}
    for name, path in paths.items():
        try:
            frames[name] = spark.read.parquet(current(spark, path)).withColumn(dataset_col, F.lit(name))
        except UNREADABLE as error:
            errors[name] = brief(error)
    return frames, errors


def read_parquet_dir(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files of a folder with each row's file name, to sort or group by."""
    return spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("file_name"))


def read_rating_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated part files without header: product id, rating."""
    return spark.read.schema(RATING_PAIR).option("sep", "\t").csv(path)


def read_events(
    spark: SparkSession, path: str | list[str], multi_line: bool = False, header: bool = True
) -> DataFrame:
    """Review events from CSV, by default with a header, columns taken by position.

    Longer rows keep their first five fields. A row too short to have a category
    stays, marked ``short``: ``good_events`` leaves it out and ``rejected_events``
    tells it. All fields stay text. With ``multi_line`` a quoted field may hold
    line breaks, at the price of one task per file; without it, files are split
    and the two halves of such a record come out as short rows.
    """
    schema = StructType([*EVENT_TEXT.fields, StructField(_CORRUPT, StringType())])
    # A parser that skips unused fields does not notice that a row is short.
    rows = (
        spark.read.schema(schema)
        .option("header", header)
        .option("enforceSchema", True)
        .option("escape", '"')
        .option("columnPruning", False)
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .csv(path)
    )
    # Only rows of an unexpected width keep their text; commas in quotes do not count.
    unquoted = F.regexp_replace(_CORRUPT, r'"(?:[^"]|"")*"', "")
    wide_enough = F.size(F.split(unquoted, ",")) >= len(EVENT_TEXT)
    whole = F.col("category").isNotNull() | F.col(_CORRUPT).isNull() | wide_enough
    return rows.withColumn("short", ~whole).drop(_CORRUPT)


def read_aggregate_lines(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated ``key, mean, count`` lines; lines of any other shape are skipped."""
    return (
        spark.read.schema(AGGREGATE_LINE)
        .option("sep", "\t")
        .option("mode", "DROPMALFORMED")
        .option("columnPruning", False)
        .csv(path)
    )


def read_json_pairs(
    spark: SparkSession,
    path: str,
    id_field: str = "parent_asin",
    rating_field: str = "average_rating",
) -> DataFrame:
    """JSON Lines to rating pairs: both fields must be there, bad lines are skipped."""
    schema = StructType([StructField(id_field, StringType()), StructField(rating_field, StringType())])
    lines = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    return lines.filter(F.col(id_field).isNotNull() & is_rating(F.col(rating_field))).select(
        one_line(F.col(id_field)).alias("product_id"),
        parse_rating(F.col(rating_field)).alias("rating"),
    )


def read_results(spark: SparkSession, path: str, level: int = 3, schema: StructType | None = None) -> DataFrame:
    """Saved JSON result folders, each row with the dataset its path names.

    Results lie at ``<dataset>/<analysis>/<name>_json/part-*``, so the dataset
    is three folders above the file.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path).select(
        name_from_path(decoded(F.col("_metadata.file_path")), level).alias("dataset"), "*"
    )
