"""Review tables derived from the star-schema test tables.

A line item stands for one review: its part is the product, the part's type
the category, the quantity gives a rating in tenths from 1.0 to 5.0 and the
price a length from 50 to 1049.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


_SCHEMAS: dict[tuple[str, str], StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the test tables; its schema is taken from a file footer once per application."""
    path = f"{folder}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def _rating() -> Column:
    return F.lit(1) + F.pmod(F.col("l_quantity").cast("int"), F.lit(41)) / F.lit(10.0)


def _length() -> Column:
    return (F.lit(50) + F.pmod(F.floor("l_extendedprice"), F.lit(1000))).cast("int")


def _reviews_by_part(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("part"),
        _rating().alias("rating"),
        F.col("l_shipdate").cast("date").alias("timestamp"),
        _length().alias("review_length"),
    )


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews without product attributes: no join, only the columns asked for are read."""
    return _reviews_by_part(spark, folder).select(
        F.col("part").cast("string").alias("product_id"), "rating", "timestamp", "review_length"
    )


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews with category, store and title of their product.

    The join strategy is left to the optimizer: it broadcasts the part side
    only below its size threshold, and splits skewed partitions otherwise.
    """
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("part"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("store"),
        F.col("p_name").alias("title"),
    )
    joined = _reviews_by_part(spark, folder).join(parts, "part")
    return joined.select(F.col("part").cast("string").alias("product_id"), *joined.columns[1:])


def review_events(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews as untyped text events, some with a bad rating, a blank id or a blank category."""
    number = F.col("l_linenumber")
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("part"), "p_type")
    rows = table(spark, folder, "lineitem").withColumn("part", F.col("l_partkey")).join(parts, "part")
    return rows.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("review_id"),
        F.when(number == 6, F.lit("  ")).otherwise(F.col("part").cast("string")).alias("product_id"),
        F.col("l_suppkey").cast("string").alias("user_id"),
        F.when(number == 7, F.lit("bad"))
        .otherwise(F.concat(F.lit(" "), _rating().cast("string")))
        .alias("rating"),
        F.when(number == 5, F.lit("")).otherwise(F.concat(F.lit(" "), "p_type")).alias("category"),
    )


def text_products(spark: SparkSession, folder: str) -> DataFrame:
    """Processed products whose texts are whole documents; unlabelled ones have no rating.

    Which text field is filled depends on the language, so that every step of
    the length cascade occurs.
    """
    documents = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    lang, text = F.col("lang"), F.col("text")
    rating = F.lit(1) + F.pmod(F.col("n_chars"), F.lit(41)) / F.lit(10.0)
    return documents.join(labels, "doc_id", "left").select(
        F.col("doc_id").cast("string").alias("product_id"),
        F.when(lang != "es", F.concat_ws(" ", "source", "lang")).alias("title"),
        F.when(F.col("quality").isNotNull(), rating).alias("rating"),
        F.col("n_chars").alias("rating_number"),
        F.when(lang == "en", text).when(lang == "fr", F.lit("")).alias("description"),
        F.when(lang == "fr", text).alias("features"),
        F.length(text).alias("review_length"),
        F.col("source").alias("category"),
        lang.alias("dataset"),
    )


def raw_products(spark: SparkSession, folder: str) -> DataFrame:
    """Raw metadata with arrays, a published average and a details text."""
    size, key = F.col("p_size"), F.col("p_partkey")
    available = F.date_add(F.lit("2015-01-01").cast("date"), F.pmod(key, F.lit(3000)).cast("int"))
    shown = F.when(size <= 35, F.date_format(available, "MMMM d, yyyy")).when(
        size <= 42, F.date_format(available, "d MMMM yyyy")
    )
    return table(spark, folder, "part").select(
        F.concat(F.lit("A"), key.cast("string")).alias("parent_asin"),
        F.col("p_name").alias("title"),
        (F.lit(1) + F.pmod(size, F.lit(41)) / F.lit(10.0)).alias("average_rating"),
        F.pmod(key, F.lit(97)).alias("rating_number"),
        F.col("p_retailprice").cast("string").alias("price"),
        F.col("p_type").alias("main_category"),
        F.col("p_brand").alias("store"),
        F.array("p_name", F.lit(None), "p_brand").alias("description"),
        F.array("p_type").alias("features"),
        F.array("p_type", "p_brand").alias("categories"),
        F.concat(F.lit('{"Date First Available": "'), shown, F.lit('", "Rank": 1}')).alias("details"),
    )


def raw_products_plain(spark: SparkSession, folder: str) -> DataFrame:
    """Another raw shape: ``asin`` and ``overall``, plain strings, its own category."""
    return table(spark, folder, "part").select(
        F.concat(F.lit("B"), F.col("p_partkey").cast("string")).alias("asin"),
        F.col("p_name").alias("title"),
        (F.col("p_size") / F.lit(10.0)).alias("overall"),
        F.col("p_retailprice").alias("price"),
        F.col("p_type").alias("description"),
        F.col("p_brand").alias("category"),
    )


def raw_products_bare(spark: SparkSession, folder: str) -> DataFrame:
    """A raw shape with neither id nor rating."""
    return table(spark, folder, "part").select(F.col("p_name").alias("title"), F.col("p_brand").alias("store"))
