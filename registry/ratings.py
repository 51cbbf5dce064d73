from pyspark.sql import functions as F

from reviewlens import views
from reviewlens.operators import prepare, ratings, topk
from reviewlens.plans.top_lists import top_lists
from reviewlens.session import scratch_path
from reviewlens.sinks import write_aggregate_lines
from reviewlens.sources import read_aggregate_lines

from registry.core import query
from registry.sql import MEASURES, RATINGS, RAW, REVIEWS, TAGGED


@query(
    "product_ratings_avg",
    f"with {RATINGS} select product_id, {MEASURES} from ratings group by product_id",
)
def product_ratings_avg(spark, folder):
    return ratings.product_ratings(views.ratings(spark, folder))


@query(
    "category_ratings_avg",
    f"with {REVIEWS} select category, {MEASURES} from reviews group by category",
)
def category_ratings_avg(spark, folder):
    return ratings.category_ratings(views.reviews(spark, folder))


@query(
    "tagged_ratings",
    f"""with {REVIEWS}
    select case when grouping(product_id) = 0 then 'PRODUCT' else 'CATEGORY' end as item_type,
           coalesce(product_id, category) as item_key, {MEASURES}
    from reviews group by grouping sets ((product_id), (category))""",
)
def tagged_ratings(spark, folder):
    return ratings.tagged_ratings(views.reviews(spark, folder))


@query(
    "dual_keys",
    f"""with {REVIEWS}, emitted as (
      select 'PRODUCT' as item_type, product_id as item_key, rating from reviews
      union all select 'CATEGORY', category, rating from reviews)
    select item_type, item_key, rating, count(*) as emitted from emitted group by all""",
)
def dual_keys(spark, folder):
    emitted = prepare.dual_keys(views.reviews(spark, folder))
    return emitted.groupBy("item_type", "item_key", "rating").agg(F.count("*").alias("emitted"))


@query(
    "nan_ratings",
    f"""with {RATINGS}, numbers as (
      select product_id, rating, tenths, row_number() over () as i from ratings where tenths <> 25)
    select product_id, {MEASURES} from numbers group by product_id""",
)
def nan_ratings(spark, folder):
    """A NaN is no rating: here, every rating of 2.5 is one."""
    source = views.ratings(spark, folder)
    value = F.when(F.round(F.col("rating") * 10) == 25, F.lit(float("nan"))).otherwise(F.col("rating"))
    return ratings.product_ratings(source.withColumn("rating", value))


@query(
    "partial_merge",
    f"with {RATINGS} select product_id, {MEASURES} from ratings group by product_id",
)
def partial_merge(spark, folder):
    """Daily partial states added up give the whole-table means."""
    daily = ratings.partial_ratings(views.ratings(spark, folder), ["product_id", "timestamp"])
    return ratings.finish(ratings.merge_partials(daily, ["product_id"]))


@query(
    "sample_job",
    f"""with {RATINGS}
    select product_id, {MEASURES} from ratings where rating <> 0 and product_id <> '' group by product_id""",
)
def sample_job(spark, folder):
    return ratings.sample_job(views.ratings(spark, folder))


@query(
    "weighted_ratings",
    f"""with {RAW}
    select main_category, round(sum(rating * rating_number) / sum(rating_number), 6) as weighted_rating,
           cast(sum(rating_number) as bigint) as rating_number, count(*) as row_count
    from raw group by main_category""",
)
def weighted_ratings(spark, folder):
    products = prepare.harmonise(prepare.with_category(views.raw_products(spark, folder), "Parts"))
    return ratings.weighted_ratings(products, ["main_category"])


@query(
    "aggregate_lines",
    f"with {REVIEWS}, {TAGGED} select item_type, item_key, avg_rating, review_count from tagged",
)
def aggregate_lines(spark, folder):
    """Aggregates written as prefixed text lines, read back and routed by their key."""
    path = scratch_path(spark, "aggregate_lines")
    write_aggregate_lines(ratings.tagged_ratings(views.reviews(spark, folder)), path)
    return prepare.known_items(prepare.route_keys(read_aggregate_lines(spark, path)))


RATING_ORDER = "avg_rating desc, item_key desc, review_count desc"
POPULARITY_ORDER = "review_count desc, item_key"


def _list(item_type: str, order: str, by: str = "") -> str:
    support = "and review_count >= 5" if item_type == "PRODUCT" else ""
    limit = "<= 10" if item_type == "PRODUCT" else "is not null"
    return f"""select * from (
      select {by} cast(row_number() over ({'partition by ' + by.rstrip(', ') if by else ''} order by {order}) as int) as rank,
             item_key, avg_rating, review_count
      from tagged where item_type = '{item_type}' {support}) where rank {limit}"""


def _sections(by: str = "") -> str:
    lists = [
        ("TOP_PRODUCTS_BY_RATING", "PRODUCT", RATING_ORDER),
        ("TOP_PRODUCTS_BY_POPULARITY", "PRODUCT", POPULARITY_ORDER),
        ("TOP_CATEGORIES_BY_RATING", "CATEGORY", RATING_ORDER),
        ("TOP_CATEGORIES_BY_POPULARITY", "CATEGORY", POPULARITY_ORDER),
    ]
    return " union all ".join(
        f"""select {by} cast({n} as int) as section_no, '{title}' as section, rank, item_key,
            avg_rating, review_count from ({_list(item_type, order, by)})"""
        for n, (title, item_type, order) in enumerate(lists, 1)
    )


@query("top_analysis", f"with {REVIEWS}, {TAGGED} {_sections()}")
def top_analysis(spark, folder):
    return top_lists(views.reviews(spark, folder))


@query(
    "top_analysis_by_dataset",
    f"""with {REVIEWS}, tagged as (
      select store as dataset, 'PRODUCT' as item_type, product_id as item_key, {MEASURES}
      from reviews group by store, product_id
      union all select store, 'CATEGORY', category, {MEASURES} from reviews group by store, category)
    {_sections('dataset, ')}""",
)
def top_analysis_by_dataset(spark, folder):
    reviews = views.reviews(spark, folder).withColumnRenamed("store", "dataset")
    return top_lists(reviews, by=["dataset"])


def _tagged(spark, folder):
    return ratings.tagged_ratings(views.reviews(spark, folder))


@query("top_products_by_rating", f"with {REVIEWS}, {TAGGED} {_list('PRODUCT', RATING_ORDER)}")
def top_products_by_rating(spark, folder):
    return topk.top_products_by_rating(_tagged(spark, folder))


@query("top_products_by_popularity", f"with {REVIEWS}, {TAGGED} {_list('PRODUCT', POPULARITY_ORDER)}")
def top_products_by_popularity(spark, folder):
    return topk.top_products_by_popularity(_tagged(spark, folder))


@query("categories_by_rating", f"with {REVIEWS}, {TAGGED} {_list('CATEGORY', RATING_ORDER)}")
def categories_by_rating(spark, folder):
    return topk.categories_by_rating(_tagged(spark, folder))


@query("categories_by_popularity", f"with {REVIEWS}, {TAGGED} {_list('CATEGORY', POPULARITY_ORDER)}")
def categories_by_popularity(spark, folder):
    return topk.categories_by_popularity(_tagged(spark, folder))


@query(
    "minimum_support",
    f"""with {REVIEWS}, {TAGGED}
    select item_type, item_key, review_count from tagged
    where item_type = 'CATEGORY' or review_count >= 30""",
)
def minimum_support(spark, folder):
    return topk.minimum_support(_tagged(spark, folder), 30).select("item_type", "item_key", "review_count")
