"""Bring raw rows to fixed shapes: harmonising, extracts, key emission, rejection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.functions import (
    clean_key,
    first_available_date,
    first_positive_length,
    has_text,
    is_rating,
    joined_text,
    one_line,
    parse_rating,
    rated,
    text_length,
)
from reviewlens.schemas import PROCESSED

# Where a processed column comes from: the first name the input has. The choice
# is made once per dataset, not per row.
# Source fields, the id of a product without one, the prefix of category keys.
ORIGINS = {"product_id": ("parent_asin", "asin"), "rating": ("average_rating", "overall")}
MISSING_ID = "unknown"

PRODUCT, CATEGORY = "PRODUCT", "CATEGORY"
CATEGORY_PREFIX = "CATEGORY_"


class MissingColumns(ValueError):
    """An operator's required input columns are not there."""


def require(df: DataFrame, *columns: str) -> DataFrame:
    absent = [name for name in columns if name not in df.columns]
    if absent:
        raise MissingColumns(f"missing columns: {', '.join(absent)}")
    return df


def with_category(df: DataFrame, category: str) -> DataFrame:
    """Constant ``category`` column unless the data has its own."""
    return df if "category" in df.columns else df.withColumn("category", F.lit(category))


def harmonise(df: DataFrame) -> DataFrame:
    """One projection from any raw shape to the processed schema, all columns typed."""

    def column(name: str, data_type) -> Column:
        source = next((c for c in ORIGINS.get(name, (name,)) if c in df.columns), None)
        if source is None:
            filler = MISSING_ID if name == "product_id" else None
            return F.lit(filler).cast(data_type).alias(name)
        value = F.col(source)
        if data_type.typeName() == "string":
            value = joined_text(value, df.schema[source].dataType)
        return value.cast(data_type).alias(name)

    return df.select(*[column(field.name, field.dataType) for field in PROCESSED.fields])


#: What an extract takes of a row (columns), and whether it takes the row at all.
Taken = tuple[list[Column], Column]


def _extracted(df: DataFrame, taken: Taken) -> DataFrame:
    columns, keep = taken
    return df.filter(keep).select(*columns)


def pair_parts(df: DataFrame) -> Taken:
    require(df, "product_id", "rating")
    return [F.col("product_id"), F.col("rating")], F.col("product_id").isNotNull() & rated(F.col("rating"))


def rating_pairs(df: DataFrame) -> DataFrame:
    """Product id and rating, both present."""
    return _extracted(df, pair_parts(df))


def time_parts(df: DataFrame) -> Taken:
    require(df, "product_id", "rating", "category", "details")
    date = first_available_date(F.col("details"))
    return [F.col("product_id"), date.alias("review_date"), F.col("rating"), F.col("category")], date.isNotNull()


def time_extract(df: DataFrame) -> DataFrame:
    """Rows whose details name a first-available date."""
    return _extracted(df, time_parts(df))


# The texts a length is taken from, in order of preference.
TEXTS = ("description", "features", "title")


def field_lengths(df: DataFrame, texts: Sequence[str] = TEXTS) -> DataFrame:
    """``<text>_length`` for each text; 0 where it is null or its column is absent."""
    return df.withColumns(
        {f"{name}_length": text_length(F.col(name)) if name in df.columns else F.lit(0) for name in texts}
    )


def length_parts(df: DataFrame, texts: Sequence[str] = TEXTS) -> Taken:
    require(df, "product_id", "rating", "category")
    length = first_positive_length([F.col(name) for name in texts if name in df.columns])
    columns = [F.col("product_id"), length.alias("review_length"), F.col("rating"), F.col("category")]
    return columns, F.coalesce(length > 0, F.lit(False))


def length_extract(df: DataFrame, texts: Sequence[str] = TEXTS) -> DataFrame:
    """Rows with any text; the length is that of the first non-empty one in ``texts``."""
    return _extracted(df, length_parts(df, texts))


def _has_key() -> Column:
    return has_text(F.col("product_id")) | has_text(F.col("category"))


def _short(events: DataFrame) -> Column:
    return F.col("short") if "short" in events.columns else F.lit(False)


def good_events(events: DataFrame) -> DataFrame:
    """Text events with a number for a rating and a key, typed and trimmed; short rows left out."""
    text = F.col("rating")
    return (
        require(events, "product_id", "rating", "category")
        .filter(~_short(events) & is_rating(text) & _has_key())
        .select(
            clean_key(F.col("product_id")).alias("product_id"),
            parse_rating(text).alias("rating"),
            clean_key(F.col("category")).alias("category"),
        )
    )


def rejected_events(events: DataFrame) -> DataFrame:
    """The other events, each with the reason why."""
    text = F.col("rating")
    return (
        require(events, "product_id", "rating", "category")
        .filter(_short(events) | ~is_rating(text) | ~_has_key())
        .select(
            clean_key(F.col("product_id")).alias("product_id"),
            text.alias("rating_text"),
            clean_key(F.col("category")).alias("category"),
            F.when(_short(events), "too few fields")
            .when(is_rating(text), "no key")
            .otherwise("rating is not a number")
            .alias("reason"),
        )
    )


def dual_keys(df: DataFrame, carry: Sequence[str] = ("rating",)) -> DataFrame:
    """Each row once under its product and once under its category, blank keys left out."""
    emitted = df.select(
        F.inline(
            F.array(
                F.struct(F.lit(PRODUCT).alias("item_type"), clean_key(F.col("product_id")).alias("item_key")),
                F.struct(F.lit(CATEGORY).alias("item_type"), clean_key(F.col("category")).alias("item_key")),
            )
        ),
        *carry,
    )
    return emitted.filter(F.col("item_key").isNotNull())


def route_keys(lines: DataFrame, key: str = "key") -> DataFrame:
    """Split prefixed text keys into item type and item key."""
    is_category = F.col(key).startswith(CATEGORY_PREFIX)
    return lines.select(
        F.when(is_category, CATEGORY).otherwise(PRODUCT).alias("item_type"),
        F.when(is_category, F.substring(key, len(CATEGORY_PREFIX) + 1, 2**31 - 1))
        .otherwise(F.col(key))
        .alias("item_key"),
        *[c for c in lines.columns if c != key],
    )


def known_items(df: DataFrame) -> DataFrame:
    """Rows of an unknown item type left out."""
    return df.filter(F.col("item_type").isin(PRODUCT, CATEGORY))


def prefixed_key(item_type: Column, item_key: Column) -> Column:
    return F.when(item_type == CATEGORY, F.concat(F.lit(CATEGORY_PREFIX), item_key)).otherwise(item_key)


def truthy_pairs(df: DataFrame) -> DataFrame:
    """Pairs with a non-empty id and a rating that is neither null nor zero."""
    return require(df, "product_id", "rating").filter(
        (F.col("product_id") != "") & (F.col("rating") != 0)
    ).select("product_id", "rating")


def sanitised_ids(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({name: one_line(F.col(name)) for name in columns or ("product_id",)})


def longer_than(df: DataFrame, limit: int = 10_000, column: str = "review_length") -> DataFrame:
    return df.filter(F.col(column) > limit)


def row_sample(
    df: DataFrame, fraction: float = 0.01, seed: int = 42, rows: int | None = None, key: Sequence[str] | None = None
) -> DataFrame:
    """A repeatable sample without replacement, drawn by a hash of each row's key (all columns by default).

    Without ``rows``, the rows whose hash lies in the lowest ``fraction``; with ``rows``, that many with
    the smallest hashes. Either way every part of the input is drawn from alike, and the sample is the
    same in any layout. Rows with equal keys are drawn together.
    """
    parts = [F.coalesce(F.col(name).cast("string"), F.lit("\u0000")) for name in key or df.columns]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts).cast("binary"))
    drawn = df.withColumn("_drawn", F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"))
    if rows is None:
        drawn = drawn.filter(F.col("_drawn") < F.lit(int(fraction * 2**32)))
    else:
        drawn = drawn.orderBy("_drawn", *(key or df.columns)).limit(rows)
    return drawn.drop("_drawn")
