from pyspark.sql import functions as F

from reviewlens import views
from reviewlens.operators import bias, stats
from reviewlens.operators.prepare import harmonise, with_category
from reviewlens.operators.quality import row_counts
from reviewlens.plans.analysis import COMBINED, analyze, save_analysis
from reviewlens.plans.datasets import union_all, union_if_complete
from reviewlens.plans.top_lists import integrated_report, top_lists
from reviewlens.session import scratch_path

from registry.core import query
from registry.ratings import RATING_ORDER, POPULARITY_ORDER, _list
from registry.sql import BUCKET, MEASURES, RAW, REVIEWS, STAR, TEXT_PRODUCTS
from registry.trends import STATS

# Every dataset once under its own name and once under the combined one.
BOTH = f"""datasets as (
  select category as dataset, * from reviews
  union all select '{COMBINED}' as dataset, * from reviews)"""
MEAN = "round(cast(sum(tenths) as double) / (10 * count(*)), 6) as avg_rating"


def _datasets(spark, folder):
    return views.reviews(spark, folder).withColumnRenamed("category", "dataset")


def _analysis(spark, folder):
    return analyze(_datasets(spark, folder), "dataset", COMBINED)


@query(
    "combined_monthly",
    f"""with {REVIEWS}, {BOTH}
    select dataset, cast(year(ts) as int) as year, cast(month(ts) as int) as month, {MEAN},
           count(*) as review_count from datasets group by 1, 2, 3""",
)
def combined_monthly(spark, folder):
    return _analysis(spark, folder)["trends"]["monthly"]


@query(
    "combined_rolling",
    f"""with {REVIEWS}, {BOTH}, monthly as (
      select dataset, cast(year(ts) as int) as year, cast(month(ts) as int) as month,
             cast(sum(tenths) as double) / (10 * count(*)) as avg_rating from datasets group by 1, 2, 3)
    select dataset, year, month, round(avg_rating, 6) as avg_rating, round(avg(avg_rating) over (
      partition by dataset order by year, month rows between 2 preceding and current row), 6) as rolling_avg
    from monthly""",
)
def combined_rolling(spark, folder):
    return _analysis(spark, folder)["trends"]["rolling"]


@query(
    "combined_bias",
    f"""with {REVIEWS}, {BOTH}
    select dataset, {BUCKET} as length_bucket, {MEAN}, count(*) as "count" from datasets group by 1, 2""",
)
def combined_bias(spark, folder):
    return _analysis(spark, folder)["bias"]["bucket_stats"]


@query(
    "combined_correlation",
    f"""with {REVIEWS}, {BOTH}
    select dataset, round(corr(review_length, rating), 6) as correlation from datasets group by 1""",
)
def combined_correlation(spark, folder):
    return _analysis(spark, folder)["bias"]["correlation"]


@query(
    "combined_stars",
    f"""with {REVIEWS}, {BOTH}
    select dataset, {STAR} as star_rating, count(*) as "count",
           round(100.0::double * count(*) / sum(count(*)) over (partition by dataset), 6) as percentage
    from datasets group by 1, 2""",
)
def combined_stars(spark, folder):
    return _analysis(spark, folder)["stats"]["star_distribution"]


STATS_ROWS = " union all ".join(
    f"select dataset, 'basic_stats' as analysis, null as rank, null as item, '{m}' as measure, "
    f"round(cast({c} as double), 6) as value from stats"
    for m, c in {
        "count": '"count"', "min": "min", "q1": "q1", "median": "median", "q3": "q3", "max": "max",
        "mean": "mean", "stddev": "stddev", "variance": "variance", "iqr": "iqr",
    }.items()
)


def _listed(title: str, item_type: str, order: str) -> str:
    listed = f"from ({_list(item_type, order, 'dataset, ')})"
    return f"""select dataset, '{title}', rank, item_key, 'mean', avg_rating {listed}
               union all select dataset, '{title}', rank, item_key, 'count', cast(review_count as double) {listed}"""


@query(
    "integrated_report",
    f"""with {REVIEWS}, {BOTH}, stats as (select dataset, {STATS} from datasets group by 1), tagged as (
      select dataset, 'PRODUCT' as item_type, product_id as item_key, {MEASURES}
      from datasets group by dataset, product_id
      union all select dataset, 'CATEGORY', store, {MEASURES} from datasets group by dataset, store)
    {STATS_ROWS}
    union all select dataset, 'bias', null, null, 'correlation', round(corr(review_length, rating), 6)
      from datasets group by 1
    union all {_listed('top_products_by_rating', 'PRODUCT', RATING_ORDER)}
    union all {_listed('top_products_by_popularity', 'PRODUCT', POPULARITY_ORDER)}
    union all {_listed('top_categories_by_rating', 'CATEGORY', RATING_ORDER)}
    union all {_listed('top_categories_by_popularity', 'CATEGORY', POPULARITY_ORDER)}""",
)
def integrated_report_query(spark, folder):
    lists = top_lists(
        _datasets(spark, folder).withColumnRenamed("store", "category"), by=["dataset"], combined=COMBINED
    )
    return integrated_report(lists, _analysis(spark, folder))


@query(
    "saved_analysis",
    f"""with {REVIEWS}, stats as (select {STATS} from reviews), lines as (
      select 'Count: ' || "count" as value from stats
      union all select 'Minimum: ' || printf('%.2f', min) from stats
      union all select 'Maximum: ' || printf('%.2f', max) from stats
      union all select 'Mean: ' || printf('%.2f', mean) from stats
      union all select 'Standard Deviation: ' || printf('%.2f', stddev) from stats
      union all select 'Median: ' || printf('%.2f', median) from stats
      union all select '25th Percentile: ' || printf('%.2f', q1) from stats
      union all select '75th Percentile: ' || printf('%.2f', q3) from stats
      union all select 'Interquartile Range: ' || printf('%.2f', iqr) from stats
      union all select 'Correlation between review length and rating: ' ||
        printf('%.4f', corr(review_length, rating)) from reviews)
    select value from lines""",
)
def saved_analysis(spark, folder):
    """The combined dataset's bundle saved to files; the lines of its two text reports."""
    path = scratch_path(spark, "analysis")
    errors = save_analysis(_analysis(spark, folder), path, COMBINED)
    if errors:
        raise AssertionError(f"analyses failed: {errors}")
    lines = spark.read.text([f"{path}/stats/basic_stats_summary", f"{path}/bias/correlation"])
    return lines.filter(F.col("value").contains(": "))


@query(
    "union_datasets",
    f"""with {REVIEWS}, {RAW}, {TEXT_PRODUCTS}, pairs as (
      select 'documents' as dataset, product_id, rating from text_products
      union all select 'parts', product_id, rating from raw
      union all select 'reviews', product_id, rating from reviews)
    select dataset, count(*) as row_count, count(rating) as rated, round(sum(rating), 6) as rating_sum
    from pairs group by dataset""",
)
def union_datasets(spark, folder):
    """Three datasets of different origin as one table, columns matched by name."""
    frames = {
        "documents": views.text_products(spark, folder).select("product_id", "rating"),
        "parts": harmonise(with_category(views.raw_products(spark, folder), "parts")).select(
            "rating", "product_id"
        ),
        "reviews": views.ratings(spark, folder).select("product_id", "rating"),
    }
    return union_all(frames).groupBy("dataset").agg(
        F.count("*").alias("row_count"),
        F.count("rating").alias("rated"),
        F.sum("rating").alias("rating_sum"),
    )


@query(
    "gated_union",
    """select 'customer' as dataset, count(*) as row_count from customer
       union all select 'supplier', count(*) from supplier""",
)
def gated_union(spark, folder):
    """Combined only when all expected parts are there, otherwise not at all."""
    frames = {
        "customer": views.table(spark, folder, "customer").select(F.col("c_acctbal").alias("rating")),
        "supplier": views.table(spark, folder, "supplier").select(F.col("s_acctbal").alias("rating")),
    }
    if union_if_complete(frames, ["customer", "supplier", "absent"]) is not None:
        raise AssertionError("an incomplete set was combined")
    return row_counts(union_if_complete(frames, ["customer", "supplier"]))


@query(
    "dataset_bias",
    f"""with {REVIEWS}, stars as (
      select category as dataset, {STAR} as rating_rounded, {BUCKET} as length_bucket from reviews)
    select dataset, rating_rounded,
      {", ".join(f'''count(*) filter (length_bucket = '{b}') as "{b}"''' for b in ("Very Short", "Short", "Medium", "Long", "Very Long"))}
    from stars group by 1, 2""",
)
def dataset_bias(spark, folder):
    partials = bias.length_partials(_datasets(spark, folder), by=["dataset"])
    return bias.rating_pivot(partials, ["dataset"])


@query(
    "dataset_histogram",
    f"""with {REVIEWS}
    select category as dataset, (tenths // 5) * 0.5::double as rating_bucket, count(*) as "count",
           round(100.0::double * count(*) / sum(count(*)) over (partition by category), 6) as percentage
    from reviews group by 1, 2""",
)
def dataset_histogram(spark, folder):
    return stats.histogram(stats.rating_counts(_datasets(spark, folder), by=["dataset"]), ["dataset"])
