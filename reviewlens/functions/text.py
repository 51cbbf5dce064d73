"""Strings: keys, names and fixed-point text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

_BLANKS = " \t\r\n\x0b\x0c"


def clean_key(key: Column) -> Column:
    """Trimmed key; a blank one becomes null."""
    return F.nullif(F.btrim(key, F.lit(_BLANKS)), F.lit(""))


def has_text(key: Column) -> Column:
    """Whether ``clean_key`` gives a value."""
    return F.coalesce(F.btrim(key, F.lit(_BLANKS)) != "", F.lit(False))


def one_line(text: Column) -> Column:
    """Tabs and line breaks replaced, so that the text fits one delimited field."""
    return F.translate(text, "\t\n", "  ")


def joined_text(column: Column, data_type: DataType) -> Column:
    """Any column as text: arrays joined by a space without their nulls, other nesting as JSON."""
    if isinstance(data_type, ArrayType):
        return F.array_join(column.cast(ArrayType(StringType())), " ")
    if isinstance(data_type, (StructType, MapType)):
        return F.to_json(column)
    return column.cast("string")


def fixed(value: Column, digits: int = 2, missing: str | None = None) -> Column:
    """Text with ``digits`` decimals; a null becomes ``missing``."""
    text = F.when(value.isNotNull(), F.format_string(f"%.{digits}f", value))
    return text if missing is None else F.coalesce(text, F.lit(missing))


def decoded(file_path: Column) -> Column:
    """A scan's ``_metadata.file_path``, which is URL-encoded, as a plain path."""
    return F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))


def name_from_path(path: Column, level: int = 1) -> Column:
    """Folder name ``level`` steps above the file (1 = the folder holding it)."""
    return F.element_at(F.split(path, "/"), -(level + 1))


def slug(name: Column) -> Column:
    """A name as part of a path: lower case, blanks as underscores."""
    return F.translate(F.lower(name), " ", "_")


def megabytes(size: Column) -> Column:
    """Bytes as units of 1024 * 1024."""
    return size / F.lit(1024.0 * 1024.0)
