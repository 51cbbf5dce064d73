from pyspark.sql import functions as F

from reviewlens import views
from reviewlens.operators import bias, charts, stats, trends

from registry.core import query
from registry.sql import BUCKET, BUCKET_ORD, RATINGS, REVIEWS, STAR

MEAN = "cast(sum(tenths) as double) / (10 * count(*)) as avg_rating, count(*) as review_count"
MONTHLY = f"""monthly as (
  select cast(year(ts) as int) as year, cast(month(ts) as int) as month, {MEAN} from ratings group by 1, 2)"""
YEARLY = f"yearly as (select cast(year(ts) as int) as year, {MEAN} from ratings group by 1)"
ROLLING = """rolling as (
  select year, month, avg_rating, avg(avg_rating) over (
    order by year, month rows between 2 preceding and current row) as rolling_avg from monthly)"""


def _partials(spark, folder):
    return trends.monthly_partials(views.ratings(spark, folder))


@query("monthly_trend", f"with {RATINGS}, {MONTHLY} select * replace (round(avg_rating, 6) as avg_rating) from monthly")
def monthly_trend(spark, folder):
    return trends.rating_trends(views.ratings(spark, folder))["monthly"]


@query("yearly_trend", f"with {RATINGS}, {YEARLY} select * replace (round(avg_rating, 6) as avg_rating) from yearly")
def yearly_trend(spark, folder):
    return trends.rating_trends(views.ratings(spark, folder))["yearly"]


@query(
    "rolling_trend",
    f"""with {RATINGS}, {MONTHLY}, {ROLLING}
    select year, month, round(avg_rating, 6) as avg_rating, round(rolling_avg, 6) as rolling_avg from rolling""",
)
def rolling_trend(spark, folder):
    return trends.rating_trends(views.ratings(spark, folder))["rolling"]


@query(
    "rolling_calendar",
    f"""with {RATINGS}, {MONTHLY}
    select year, month, round(avg_rating, 6) as avg_rating, round(avg(avg_rating) over (
      order by year * 12 + month range between 2 preceding and current row), 6) as rolling_avg
    from monthly""",
)
def rolling_calendar(spark, folder):
    return trends.rolling(_partials(spark, folder), calendar=True)


@query(
    "category_trend",
    f"""with {REVIEWS}
    select category, cast(year(ts) as int) as year, cast(month(ts) as int) as month,
           round(cast(sum(tenths) as double) / (10 * count(*)), 6) as avg_rating, count(*) as review_count
    from reviews group by 1, 2, 3""",
)
def category_trend(spark, folder):
    return trends.category_trend(views.reviews(spark, folder))


@query(
    "seasonality",
    f"""with {RATINGS}
    select cast(month(ts) as int) as month,
           round(cast(sum(tenths) as double) / (10 * count(*)), 6) as avg_rating, count(*) as review_count
    from ratings group by 1""",
)
def seasonality(spark, folder):
    return trends.seasonality(_partials(spark, folder))


BUCKETS = f"""buckets as (
  select {BUCKET} as length_bucket, {STAR} as rating_rounded, tenths, rating from ratings)"""
BUCKET_STATS = """bucket_stats as (
  select length_bucket, round(cast(sum(tenths) as double) / (10 * count(*)), 6) as avg_rating,
         count(*) as "count" from buckets group by 1)"""
LABELS = ("Very Short", "Short", "Medium", "Long", "Very Long")


@query("length_buckets", f"with {RATINGS}, {BUCKETS}, {BUCKET_STATS} select * from bucket_stats")
def length_buckets(spark, folder):
    return bias.length_bias(views.ratings(spark, folder))["bucket_stats"]


@query(
    "rating_length_pivot",
    f"""with {RATINGS}, {BUCKETS} select rating_rounded,
    {", ".join(f'''count(*) filter (length_bucket = '{b}') as "{b}"''' for b in LABELS)}
    from buckets group by rating_rounded""",
)
def rating_length_pivot(spark, folder):
    return bias.length_bias(views.ratings(spark, folder))["rating_pivot"]


@query(
    "length_rating_corr",
    f"with {RATINGS} select round(corr(review_length, rating), 6) as correlation from ratings",
)
def length_rating_corr(spark, folder):
    return bias.length_bias(views.ratings(spark, folder))["correlation"]


@query(
    "length_rating_corr_by_category",
    f"""with {REVIEWS} select category, round(corr(review_length, rating), 6) as correlation
    from reviews group by category""",
)
def length_rating_corr_by_category(spark, folder):
    return bias.length_correlation(views.reviews(spark, folder), by=["category"])


STATS = """count(*) as "count", min(rating) as min, quantile_cont(rating, 0.25) as q1,
  quantile_cont(rating, 0.5) as median, quantile_cont(rating, 0.75) as q3, max(rating) as max,
  avg(rating) as mean, stddev_samp(rating) as stddev, var_samp(rating) as variance,
  quantile_cont(rating, 0.75) - quantile_cont(rating, 0.25) as iqr"""
STATS_6 = """"count", round(min, 6) as min, round(q1, 6) as q1, round(median, 6) as median,
  round(q3, 6) as q3, round(max, 6) as max, round(mean, 6) as mean, round(stddev, 6) as stddev,
  round(variance, 6) as variance, round(iqr, 6) as iqr"""


@query("basic_stats", f"with {RATINGS} select {STATS_6} from (select {STATS} from ratings)")
def basic_stats(spark, folder):
    return stats.rating_distribution(views.ratings(spark, folder))["basic_stats"]


@query(
    "basic_stats_by_category",
    f"with {REVIEWS} select category, {STATS_6} from (select category, {STATS} from reviews group by category)",
)
def basic_stats_by_category(spark, folder):
    counts = stats.rating_counts(views.reviews(spark, folder), by=["category"])
    return stats.basic_stats(counts, ["category"])


@query(
    "exact_quantiles",
    """select l_returnflag, round(quantile_cont(l_extendedprice, 0.25), 6) as q1,
              round(quantile_cont(l_extendedprice, 0.5), 6) as median,
              round(quantile_cont(l_extendedprice, 0.75), 6) as q3
       from lineitem group by l_returnflag""",
)
def exact_quantiles(spark, folder):
    """Quartiles of a column with about as many distinct values as rows."""
    items = views.table(spark, folder, "lineitem")
    return stats.exact_quantiles(items, by=["l_returnflag"], value="l_extendedprice")


@query(
    "exact_quantiles_overall",
    f"""with {RATINGS}
    select round(quantile_cont(rating, 0.25), 6) as q1, round(quantile_cont(rating, 0.5), 6) as median,
           round(quantile_cont(rating, 0.75), 6) as q3 from ratings""",
)
def exact_quantiles_overall(spark, folder):
    return stats.exact_quantiles(views.ratings(spark, folder))


PRICES = STATS.replace("rating", "l_extendedprice")


@query(
    "exact_stats",
    f"""select l_returnflag, {STATS_6.replace("round(variance, 6)", "round(variance / 1e6, 6)")} from (
      select l_returnflag, {PRICES} from lineitem group by l_returnflag)""",
)
def exact_stats(spark, folder):
    """The statistics row of a column without a scale, quartiles exact."""
    items = views.table(spark, folder, "lineitem")
    found = stats.exact_stats(items, "l_extendedprice", ["l_returnflag"], centre=50_000.0)
    return found.withColumn("variance", F.col("variance") / 1e6)


@query(
    "continuous_stats",
    f"""select l_returnflag, "count", round(min, 6) as min, round(max, 6) as max, round(mean, 6) as mean,
           round(stddev, 6) as stddev, true as q1_near, true as median_near, true as q3_near,
           true as bounded
    from (select l_returnflag, {PRICES} from lineitem group by l_returnflag)""",
)
def continuous_stats(spark, folder):
    """The same from the state of fixed size; for each quartile, whether its value is within the stated
    error of the exact one, and whether there are as few bands as stated."""
    items = views.table(spark, folder, "lineitem")
    by = ["l_returnflag"]
    bands = stats.rating_counts(items, "l_extendedprice", by, centre=50_000.0)
    exact = stats.exact_quantiles(items, by=by, value="l_extendedprice")
    row = stats.basic_stats(bands, by, centre=50_000.0)
    # values from 512 to 131072 span eight powers of two
    few = bands.groupBy(*by).agg((F.count("*") <= 8 * 8192).alias("bounded"))
    both = row.join(exact.withColumnsRenamed({q: f"exact_{q}" for q in stats.QUARTILES}), "l_returnflag").join(few, "l_returnflag")
    near = [(F.abs(F.col(q) - F.col(f"exact_{q}")) <= F.col(f"exact_{q}") / 8192).alias(f"{q}_near") for q in stats.QUARTILES]
    return both.select("l_returnflag", "count", "min", "max", "mean", "stddev", *near, "bounded")


@query(
    "approx_stats",
    f"""with {RATINGS}
    select count(*) as "count", round(min(rating), 6) as min, round(max(rating), 6) as max,
           round(avg(rating), 6) as mean, round(stddev_samp(rating), 6) as stddev,
           round(var_samp(rating), 6) as variance, true as q1, true as median, true as q3
    from ratings""",
)
def approx_stats(spark, folder):
    """The sketched row; for each quartile, whether its rank is within the sketch's stated error."""
    ratings = views.ratings(spark, folder)
    row = stats.approx_stats(ratings, accuracy=1000)
    one = row.first()  # three numbers to hold the ratings against
    within = {}
    for name, share in stats.QUARTILES.items():
        wanted, slack = share * one["count"], one["count"] / 1000 + 1
        within[name] = (F.count_if(F.col("rating") < one[name]) <= wanted + slack) & (
            F.count_if(F.col("rating") <= one[name]) >= wanted - slack
        )
    checked = ratings.agg(*[test.alias(name) for name, test in within.items()])
    plain = row.select("count", "min", "max", "mean", "stddev", "variance")
    both = plain.unionByName(checked, allowMissingColumns=True)
    return both.agg(*[F.max(name).alias(name) for name in both.columns])


# A bucket of width 0.5 is five tenths wide.
HISTOGRAM = """histogram as (
  select (tenths // 5) * 0.5::double as rating_bucket, count(*) as "count",
         100.0::double * count(*) / sum(count(*)) over () as percentage from ratings group by 1)"""
STARS = f"""stars as (
  select {STAR} as star_rating, count(*) as "count",
         100.0::double * count(*) / sum(count(*)) over () as percentage from ratings group by 1)"""


@query(
    "rating_histogram",
    f"""with {RATINGS}, {HISTOGRAM}
    select rating_bucket, "count", round(percentage, 6) as percentage from histogram""",
)
def rating_histogram(spark, folder):
    return stats.rating_distribution(views.ratings(spark, folder))["histogram"]


@query(
    "star_distribution",
    f"""with {RATINGS}, {STARS}
    select star_rating, "count", round(percentage, 6) as percentage from stars""",
)
def star_distribution(spark, folder):
    return stats.rating_distribution(views.ratings(spark, folder))["star_distribution"]


DATE = "cast(make_date(year, month, 1) as varchar) as date"


@query(
    "chart_monthly",
    f"""with {RATINGS}, {MONTHLY}
    select {DATE}, round(avg_rating, 6) as avg_rating, review_count from monthly""",
)
def chart_monthly(spark, folder):
    return charts.monthly_chart(trends.monthly(_partials(spark, folder)))


@query(
    "chart_yearly",
    f"""with {RATINGS}, {YEARLY}
    select cast(year as varchar) as year, round(avg_rating, 6) as avg_rating, review_count from yearly""",
)
def chart_yearly(spark, folder):
    return charts.yearly_chart(trends.yearly(_partials(spark, folder)))


@query(
    "chart_rolling",
    f"""with {RATINGS}, {MONTHLY}, {ROLLING}
    select {DATE}, round(avg_rating, 6) as avg_rating, round(rolling_avg, 6) as rolling_avg from rolling""",
)
def chart_rolling(spark, folder):
    return charts.rolling_chart(trends.rolling(_partials(spark, folder)))


@query(
    "chart_buckets",
    f"""with {RATINGS}, {BUCKETS}, {BUCKET_STATS}
    select cast({BUCKET_ORD} as int) as bucket_ord, length_bucket, avg_rating, "count",
           'n=' || "count" as label from bucket_stats""",
)
def chart_buckets(spark, folder):
    return charts.bucket_chart(bias.bucket_stats(bias.length_partials(views.ratings(spark, folder))))


@query(
    "chart_stacked",
    f"""with {RATINGS}, {BUCKETS}, stars as (select distinct rating_rounded from buckets),
    labels as (select unnest(['Very Short', 'Short', 'Medium', 'Long', 'Very Long']) as length_bucket),
    cells as (
      select s.rating_rounded, l.length_bucket, cast({BUCKET_ORD.replace('length_bucket', 'l.length_bucket')} as int) as bucket_ord,
             count(b.tenths) as "count"
      from stars s cross join labels l
      left join buckets b on b.rating_rounded = s.rating_rounded and b.length_bucket = l.length_bucket
      group by 1, 2, 3)
    select rating_rounded, bucket_ord, length_bucket, "count",
           cast(coalesce(sum("count") over (partition by rating_rounded order by bucket_ord
             rows between unbounded preceding and 1 preceding), 0) as bigint) as bottom from cells""",
)
def chart_stacked(spark, folder):
    return charts.stacked_chart(bias.rating_pivot(bias.length_partials(views.ratings(spark, folder))))


@query(
    "chart_correlation",
    f"""with {RATINGS}, c as (select corr(review_length, rating) as r from ratings)
    select round(r, 6) as correlation, printf('%.4f', r) as label,
           case when r <= -0.5 then 'Strong Negative' when r <= -0.3 then 'Moderate Negative'
                when r < 0.3 then 'Weak/No Correlation' when r < 0.5 then 'Moderate Positive'
                else 'Strong Positive' end as band from c""",
)
def chart_correlation(spark, folder):
    return charts.correlation_chart(bias.length_correlation(views.ratings(spark, folder)))


@query(
    "chart_histogram",
    f"""with {RATINGS}, {HISTOGRAM}
    select rating_bucket, "count", round(percentage, 6) as percentage,
           printf('%.1f', percentage) || '%' as label from histogram""",
)
def chart_histogram(spark, folder):
    return charts.histogram_chart(stats.histogram(stats.rating_counts(views.ratings(spark, folder))))


@query(
    "chart_stars",
    f"""with {RATINGS}, {STARS}
    select star_rating, "count", round(percentage, 6) as percentage,
           printf('%.1f', percentage) || '%' as label from stars""",
)
def chart_stars(spark, folder):
    return charts.star_chart(stats.star_distribution(stats.rating_counts(views.ratings(spark, folder))))


@query(
    "chart_box",
    f"""with {RATINGS}, s as (select {STATS} from ratings)
    select round(min, 6) as min, round(q1, 6) as q1, round(median, 6) as median, round(q3, 6) as q3,
           round(max, 6) as max, round(mean, 6) as mean,
           concat_ws(',', printf('%.2f', min), printf('%.2f', q1), printf('%.2f', median),
                     printf('%.2f', q3), printf('%.2f', max)) as box,
           'Min: ' || printf('%.2f', min) as min_label, 'Q1: ' || printf('%.2f', q1) as q1_label,
           'Median: ' || printf('%.2f', median) as median_label, 'Q3: ' || printf('%.2f', q3) as q3_label,
           'Max: ' || printf('%.2f', max) as max_label, 'Mean: ' || printf('%.2f', mean) as mean_label
    from s""",
)
def chart_box(spark, folder):
    from pyspark.sql import functions as F

    box = charts.box_chart(stats.rating_distribution(views.ratings(spark, folder))["basic_stats"])
    text = F.array_join(F.transform("box", lambda x: F.format_string("%.2f", x)), ",")
    return box.withColumn("box", text)
