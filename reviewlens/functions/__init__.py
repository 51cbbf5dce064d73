"""Column functions: everything here builds JVM-side expressions only."""

from reviewlens.functions.correlation import correlation_band, safe_corr
from reviewlens.functions.dates import days_before, first_available_date, month_start
from reviewlens.functions.lengths import (
    LENGTH_EDGES,
    LENGTH_LABELS,
    bucket_ordinal,
    first_positive_length,
    length_bucket,
    text_length,
)
from reviewlens.functions.order import BAND_BITS, band, rounded
from reviewlens.functions.ratings import (
    finite,
    half_step,
    is_rating,
    parse_rating,
    percent,
    rated,
    star,
    two_decimals,
)
from reviewlens.functions.text import (
    clean_key,
    decoded,
    fixed,
    has_text,
    joined_text,
    megabytes,
    name_from_path,
    one_line,
    slug,
)

__all__ = [
    "BAND_BITS",
    "LENGTH_EDGES",
    "LENGTH_LABELS",
    "band",
    "bucket_ordinal",
    "clean_key",
    "correlation_band",
    "days_before",
    "decoded",
    "finite",
    "first_available_date",
    "first_positive_length",
    "fixed",
    "half_step",
    "has_text",
    "is_rating",
    "joined_text",
    "length_bucket",
    "megabytes",
    "month_start",
    "name_from_path",
    "one_line",
    "parse_rating",
    "percent",
    "rated",
    "rounded",
    "safe_corr",
    "slug",
    "star",
    "text_length",
    "two_decimals",
]
