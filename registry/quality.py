from pyspark.sql import functions as F

from reviewlens import views
from reviewlens.operators import prepare, quality

from registry.core import query
from registry.sql import RATINGS, REVIEWS, TEXT_PRODUCTS, missing_rows, summary

COLUMNS = [
    "product_id", "title", "rating", "rating_number", "description", "features",
    "review_length", "category",
]


@query(
    "missing_profile",
    f"with {TEXT_PRODUCTS} {missing_rows('text_products', [*COLUMNS, 'dataset'])}",
)
def missing_profile(spark, folder):
    return quality.missing_profile(views.text_products(spark, folder))


@query("rating_frequency", f'with {RATINGS} select rating, count(*) as "count" from ratings group by rating')
def rating_frequency(spark, folder):
    return quality.rating_frequency(views.ratings(spark, folder))


@query(
    "category_frequency",
    f'with {REVIEWS} select category, count(*) as "count" from reviews group by category',
)
def category_frequency(spark, folder):
    return quality.category_frequency(views.reviews(spark, folder))


@query("rating_summary", f"with {RATINGS} select {summary('rating', 'rating')} from ratings")
def rating_summary(spark, folder):
    return quality.rating_summary(views.ratings(spark, folder))


@query(
    "length_summary",
    f"with {TEXT_PRODUCTS} select {summary('review_length', 'length')} from text_products",
)
def length_summary(spark, folder):
    return quality.length_summary(views.text_products(spark, folder))


@query(
    "outlier_share",
    f"""with {TEXT_PRODUCTS}
    select dataset, count(*) filter (review_length > 10000) as outlier_count,
           round(100.0 * count(*) filter (review_length > 10000) / count(*), 6) as outlier_pct
    from text_products group by dataset""",
)
def outlier_share(spark, folder):
    return quality.outlier_share(views.text_products(spark, folder), by=["dataset"])


@query(
    "outlier_rows",
    f"""with {TEXT_PRODUCTS}
    select product_id, review_length from text_products where review_length > 10000""",
)
def outlier_rows(spark, folder):
    return prepare.longer_than(views.text_products(spark, folder)).select("product_id", "review_length")


@query("row_counts", f"with {TEXT_PRODUCTS} select dataset, count(*) as row_count from text_products group by 1")
def row_counts(spark, folder):
    return quality.row_counts(views.text_products(spark, folder))


REPORT = f"""report as (
  select dataset, count(*) as total_records, {summary('rating', 'rating')},
         {summary('review_length', 'length')},
         count(*) filter (review_length > 10000) as outlier_count,
         round(100.0 * count(*) filter (review_length > 10000) / count(*), 6) as outlier_pct,
         count(*) - count(rating) as missing_ratings, count(*) - count(description) as missing_descriptions,
         'Passed' as validation_status
  from text_products group by dataset)"""


def _missing(name, column):
    found = F.filter("missing", lambda m: m["column"] == column)
    return found[0]["missing_count"].alias(name)


@query("validation_report", f"with {TEXT_PRODUCTS}, {REPORT} select * from report")
def validation_report(spark, folder):
    report = quality.validation_report(views.text_products(spark, folder))
    return report.select(
        "*",
        _missing("missing_ratings", "rating"),
        _missing("missing_descriptions", "description"),
    ).drop("missing")


@query(
    "validation_rollup",
    f"""with {TEXT_PRODUCTS}, {REPORT}
    select cast(count(*) + 1 as bigint) as datasets, count(*) as success_count,
           cast(1 as bigint) as failed_count, cast(sum(total_records) as bigint) as total_records
    from report""",
)
def validation_rollup(spark, folder):
    """The languages present and one dataset that has no rows."""
    report = quality.validation_report(
        views.text_products(spark, folder), expected=["de", "en", "es", "fr", "it"]
    )
    return quality.validation_rollup(report)


@query(
    "step_counts",
    f"""with {TEXT_PRODUCTS}
    select count(*) as initial_count, count(rating) as final_count, count(*) - count(rating) as removed_count
    from text_products""",
)
def step_counts(spark, folder):
    return quality.step_counts(views.text_products(spark, folder), prepare.rating_pairs)
