"""Explicit schemas, so that no read needs an inference pass."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


RATING_PAIR = _struct(product_id=StringType(), rating=DoubleType())

# Types of the raw product metadata fields; no dataset has all of them.
RAW_FIELDS = _struct(
    parent_asin=StringType(),
    asin=StringType(),
    title=StringType(),
    average_rating=DoubleType(),
    overall=DoubleType(),
    rating_number=LongType(),
    price=StringType(),
    main_category=StringType(),
    store=StringType(),
    description=ArrayType(StringType()),
    features=ArrayType(StringType()),
    categories=ArrayType(StringType()),
    details=StringType(),
)


def raw_schema(*fields: str) -> StructType:
    """Schema for a raw dataset that is known to have these fields."""
    return StructType([RAW_FIELDS[name] for name in fields])


# One fixed shape for every dataset after harmonising.
PROCESSED = _struct(
    product_id=StringType(),
    title=StringType(),
    rating=DoubleType(),
    rating_number=LongType(),
    price=StringType(),
    main_category=StringType(),
    store=StringType(),
    description=StringType(),
    features=StringType(),
    categories=StringType(),
    details=StringType(),
    category=StringType(),
)

# Review events: five CSV columns by position, all text until validated.
EVENT_TEXT = _struct(
    review_id=StringType(),
    product_id=StringType(),
    user_id=StringType(),
    rating=StringType(),
    category=StringType(),
)

TIME_EXTRACT = _struct(
    product_id=StringType(), review_date=DateType(), rating=DoubleType(), category=StringType()
)
LENGTH_EXTRACT = _struct(
    product_id=StringType(), review_length=IntegerType(), rating=DoubleType(), category=StringType()
)

# key <tab> mean with two decimals <tab> count; category keys carry a prefix.
AGGREGATE_LINE = _struct(key=StringType(), avg_rating=DoubleType(), review_count=LongType())
