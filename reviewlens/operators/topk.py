"""Ranked lists of products and categories, by rating and by popularity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.operators.places import numbered
from reviewlens.operators.prepare import CATEGORY, PRODUCT

# Section titles in report order.
SECTIONS = (
    "TOP_PRODUCTS_BY_RATING",
    "TOP_PRODUCTS_BY_POPULARITY",
    "TOP_CATEGORIES_BY_RATING",
    "TOP_CATEGORIES_BY_POPULARITY",
)
TOP = 10
MIN_REVIEWS = 5

_COLUMNS = ("item_key", "avg_rating", "review_count")


def minimum_support(tagged: DataFrame, min_reviews: int = MIN_REVIEWS) -> DataFrame:
    """Products need ``min_reviews`` ratings to be listed; categories are always kept."""
    return tagged.filter((F.col("item_type") == CATEGORY) | (F.col("review_count") >= min_reviews))


def rating_order() -> list[Column]:
    """Highest mean first; equal means by key, then count, all descending."""
    return [F.desc("avg_rating"), F.desc("item_key"), F.desc("review_count")]


def popularity_order() -> list[Column]:
    """Most ratings first; equal counts by ascending key."""
    return [F.desc("review_count"), F.asc("item_key")]


def ranked(
    tagged: DataFrame, item_type: str, order: Sequence[Column], top: int, by: Sequence[str] = ()
) -> DataFrame:
    """The best ``top`` items of each ``by`` group, numbered.

    Works on aggregated rows; each task keeps only its own best ones before
    anything is shuffled.
    """
    items = tagged.filter(F.col("item_type") == item_type).select(*by, *_COLUMNS)
    if not by:
        items = items.orderBy(*order).limit(top)
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    numbered = items.withColumn("rank", rank).filter(F.col("rank") <= top)
    return numbered.select(*by, "rank", *_COLUMNS)


def top_products_by_rating(tagged, top=TOP, min_reviews=MIN_REVIEWS, by=()) -> DataFrame:
    return ranked(minimum_support(tagged, min_reviews), PRODUCT, rating_order(), top, by)


def top_products_by_popularity(tagged, top=TOP, min_reviews=MIN_REVIEWS, by=()) -> DataFrame:
    return ranked(minimum_support(tagged, min_reviews), PRODUCT, popularity_order(), top, by)


def _listed(items: DataFrame, sections: Sequence[int], by: Sequence[str]) -> DataFrame:
    """Every item once per section; odd sections go by rating, even ones by popularity.

    ``score`` is the section's main measure. Equal scores go by descending key
    in a rating list and by ascending key in a popularity list.
    """
    key, none = F.col("item_key"), F.lit(None)

    def entry(section: int) -> Column:
        by_rating = section % 2 == 1
        return F.struct(
            F.lit(section).alias("section_no"),
            F.col("avg_rating" if by_rating else "review_count").cast("double").alias("score"),
            (key if by_rating else none).cast("string").alias("last_key_first"),
            (none if by_rating else key).cast("string").alias("first_key_first"),
        )

    return items.select(*by, *_COLUMNS, F.inline(F.array(*[entry(section) for section in sections])))


def _list_order() -> list[Column]:
    return [F.desc("score"), F.desc("last_key_first"), F.asc("first_key_first")]


def _top_of_lists(listed: DataFrame, by: Sequence[str], top: int) -> DataFrame:
    window = Window.partitionBy(*by, "section_no").orderBy(*_list_order())
    return listed.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= top)


def _whole_lists(listed: DataFrame, by: Sequence[str]) -> DataFrame:
    """Number complete lists without putting a list into one task."""
    return numbered(listed, _list_order(), [*by, "section_no"]).withColumn("rank", F.col("rank").cast("int"))


def _whole_list(tagged: DataFrame, section: int, by: Sequence[str]) -> DataFrame:
    categories = tagged.filter(F.col("item_type") == CATEGORY)
    return _whole_lists(_listed(categories, [section], by), by).select(*by, "rank", *_COLUMNS)


def categories_by_rating(tagged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return _whole_list(tagged, 3, by)


def categories_by_popularity(tagged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return _whole_list(tagged, 4, by)


def top_analysis(
    tagged: DataFrame, top: int = TOP, min_reviews: int = MIN_REVIEWS, by: Sequence[str] = ()
) -> DataFrame:
    """All four lists as one table, keyed by ``section_no`` and ``rank``.

    Reads ``tagged`` for the products and for the categories, so it should be a written table.
    """
    supported = minimum_support(tagged, min_reviews)
    products = _listed(supported.filter(F.col("item_type") == PRODUCT), [1, 2], by)
    categories = _listed(supported.filter(F.col("item_type") == CATEGORY), [3, 4], by)
    titles = F.array(*[F.lit(title) for title in SECTIONS])
    return (
        _top_of_lists(products, by, top)
        .unionByName(_whole_lists(categories, by), allowMissingColumns=True)
        .select(*by, "section_no", titles[F.col("section_no") - 1].alias("section"), "rank", *_COLUMNS)
    )
