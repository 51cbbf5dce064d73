import math
from collections import defaultdict
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewlens.operators import prepare, ratings, topk
from reviewlens.plans.top_lists import top_lists
from reviewlens.sources import read_events

EVENTS = """review_id,product_id,user_id,rating,category
a1,lamp,ann,2.5,home
a2,lamp,bob,4.0,home
a3,lamp,cyd,4.0,home
a4,rope,ann,1.0,outdoor
a5,rope,dan,3.5,outdoor
a6,kite,eve,5.0,outdoor
a7,vase,eve,5.0,home
"""
BAD_EVENTS = """review_id,product_id,user_id,rating,category
r1,p1,u1,4.5,c1
r2,p2,u2,bad,c1
r3,p3,u3
r4,p4,u4,3.0
r5,,u5, 2.5 ,c2
r6,"p,6",u6,3,c1,extra
r7,p7,u7,1.0,
r8,p8,u8,nan,c1
r9,p9,u9,2.0,,extra
r10,"p,10","u,10",4.0
"""
SHOWN = ("item_type", "item_key", "avg_rating", "review_count")


def events(spark, tmp_path, text):
    path = tmp_path / "events.csv"
    path.write_text(text)
    return prepare.good_events(read_events(spark, str(path)))


def test_means_and_counts_of_the_known_events(spark, tmp_path, rows):
    tagged = ratings.tagged_ratings(events(spark, tmp_path, EVENTS))
    assert rows(tagged, *SHOWN) == [
        ("CATEGORY", "home", 3.88, 4),
        ("CATEGORY", "outdoor", 3.17, 3),
        ("PRODUCT", "kite", 5.0, 1),
        ("PRODUCT", "lamp", 3.5, 3),
        ("PRODUCT", "rope", 2.25, 2),
        ("PRODUCT", "vase", 5.0, 1),
    ]


def test_emitted_lines_of_the_known_events(spark, tmp_path):
    data = events(spark, tmp_path, EVENTS)
    emitted = prepare.dual_keys(data)
    key = prepare.prefixed_key(F.col("item_type"), F.col("item_key"))
    lines = {r.line for r in emitted.select(F.concat_ws("\t", key, F.col("rating").cast("string")).alias("line")).collect()}
    assert emitted.count() == 14
    assert {"kite\t5.0", "lamp\t2.5", "CATEGORY_home\t2.5", "CATEGORY_outdoor\t1.0"} <= lines
    assert not any(line.startswith("CATEGORY_lamp") for line in lines)


def test_top_lists_of_the_known_events(spark, tmp_path):
    data = events(spark, tmp_path, EVENTS)
    ranked = lambda lists: [(r.section_no, r.item_key) for r in lists.orderBy("section_no", "rank").collect()]
    assert ranked(top_lists(data)) == [(3, "home"), (3, "outdoor"), (4, "home"), (4, "outdoor")]
    products = top_lists(data, min_reviews=1).filter("section_no < 3")
    by_rating, by_count = ["vase", "kite", "lamp", "rope"], ["lamp", "rope", "kite", "vase"]
    assert ranked(products) == [*((1, item) for item in by_rating), *((2, item) for item in by_count)]


def test_top_lists_with_the_combined_dataset(spark, tmp_path):
    data = events(spark, tmp_path, EVENTS).withColumn("dataset", F.col("category"))
    lists = top_lists(data, min_reviews=1, by=["dataset"], combined="all")
    first = {(r.dataset, r.section_no): r.item_key for r in lists.filter("rank = 1").collect()}
    assert first["all", 1] == "vase" and first["outdoor", 1] == "kite" and first["all", 4] == "home"


def test_keys_are_trimmed_everywhere(spark, rows):
    df = spark.createDataFrame([(" p", 1.0, "c "), ("p", 3.0, "c"), (" ", 5.0, " ")], "product_id string, rating double, category string")
    assert rows(ratings.product_ratings(df), "product_id", "avg_rating", "review_count") == [("p", 2.0, 2)]
    assert rows(ratings.category_ratings(df), "category", "avg_rating", "review_count") == [("c", 2.0, 2)]


def test_every_record_is_good_or_rejected(spark, tmp_path):
    path = tmp_path / "broken.csv"
    path.write_text('h1,h2,h3,h4,h5\nr1,"p\n1",u,4.0,c1\nr2,p2,u,3.0,c1\nr3,p3,u\nr4,p4,u,x,c1,more\nr5,,u,1.0,\n')
    whole = read_events(spark, str(path), multi_line=True)
    assert sorted(r.product_id for r in prepare.good_events(whole).collect()) == ["p\n1", "p2"]
    reasons = sorted(r.reason for r in prepare.rejected_events(whole).collect())
    assert reasons == ["no key", "rating is not a number", "too few fields"]
    split = read_events(spark, str(path))
    assert [r.product_id for r in prepare.good_events(split).collect()] == ["p2"]
    assert sum(r.reason == "too few fields" for r in prepare.rejected_events(split).collect()) == 3


def test_bad_rows_are_dropped_whole(spark, tmp_path, rows):
    tagged = ratings.tagged_ratings(events(spark, tmp_path, BAD_EVENTS))
    assert rows(tagged, *SHOWN) == [
        ("CATEGORY", "c1", 3.75, 2),
        ("CATEGORY", "c2", 2.5, 1),
        ("PRODUCT", "p,6", 3.0, 1),
        ("PRODUCT", "p1", 4.5, 1),
        ("PRODUCT", "p7", 1.0, 1),
        ("PRODUCT", "p9", 2.0, 1),
    ]


def test_rejected_rows_name_their_reason(spark, tmp_path, rows):
    path = tmp_path / "events.csv"
    path.write_text(BAD_EVENTS)
    rejected = prepare.rejected_events(read_events(spark, str(path)))
    assert rows(rejected, "product_id", "rating_text", "reason") == [
        ("p,10", "4.0", "too few fields"),
        ("p2", "bad", "rating is not a number"),
        ("p3", None, "too few fields"),
        ("p4", "3.0", "too few fields"),
        ("p8", "nan", "rating is not a number"),
    ]


def test_no_row_is_lost_at_file_splits(spark, tmp_path):
    """Only header lines are skipped, however many tasks read a file."""
    lines = [f"r{i},p{i % 7},u,{1 + i % 5}.0,c" for i in range(20_000)]
    (tmp_path / "big.csv").write_text("review_id,product_id,user_id,rating,category\n" + "\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        events_read = read_events(spark, str(tmp_path / "big.csv"))
        assert events_read.rdd.getNumPartitions() > 4
        assert events_read.count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_category_like_product_ids_are_not_misrouted(spark, rows):
    df = spark.createDataFrame(
        [("CATEGORY_x", 4.0, "x"), ("p", 2.0, "x")], "product_id string, rating double, category string"
    )
    assert ("PRODUCT", "CATEGORY_x", 4.0, 1) in rows(ratings.tagged_ratings(df), *SHOWN)


def test_ranking_ties(spark):
    data = [("a", 4.5, 9), ("b", 4.5, 5), ("c", 4.5, 7), ("d", 3.0, 9), ("e", 5.0, 4)]
    tagged = spark.createDataFrame(
        [("PRODUCT", *row) for row in data],
        "item_type string, item_key string, avg_rating double, review_count bigint",
    )
    by_rating = topk.top_products_by_rating(tagged).orderBy("rank").collect()
    by_popularity = topk.top_products_by_popularity(tagged).orderBy("rank").collect()
    assert [r.item_key for r in by_rating] == ["c", "b", "a", "d"]
    assert [r.item_key for r in by_popularity] == ["a", "d", "c", "b"]
    both = topk.top_analysis(tagged).orderBy("section_no", "rank").collect()
    assert [r.item_key for r in both] == ["c", "b", "a", "d", "a", "d", "c", "b"]


EVENT = st.tuples(
    st.sampled_from(["p1", "p2", "p3", " p1", "", "CATEGORY_a"]),
    st.integers(10, 50),
    st.sampled_from(["a", "b", " ", ""]),
)
spark_settings = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def folded(data):
    """Plain fold over the events: exact sums per tagged key."""
    sums = defaultdict(lambda: [0, 0])
    for product, tenths, category in data:
        for item_type, key in (("PRODUCT", product.strip()), ("CATEGORY", category.strip())):
            if key:
                sums[item_type, key][0] += tenths
                sums[item_type, key][1] += 1
    return {
        key: (math.floor(Fraction(total * 10, n) + Fraction(1, 2)) / 100, n)
        for key, (total, n) in sums.items()
    }


def review_frame(spark, data):
    return spark.createDataFrame(
        [(p, t / 10, c) for p, t, c in data], "product_id string, rating double, category string"
    )


@spark_settings
@given(st.lists(EVENT, max_size=60))
def test_tagged_ratings_equal_a_fold(spark, data):
    tagged = ratings.tagged_ratings(review_frame(spark, data)).collect()
    assert {(r.item_type, r.item_key): (r.avg_rating, r.review_count) for r in tagged} == folded(data)


@spark_settings
@given(st.lists(EVENT, min_size=1, max_size=80))
def test_lists_equal_sorting(spark, data):
    lists = top_lists(review_frame(spark, data), top=2, min_reviews=3).collect()
    items = [(t, k, avg, n) for (t, k), (avg, n) in folded(data).items()]
    products = [(avg, k, n) for t, k, avg, n in items if t == "PRODUCT" and n >= 3]
    categories = [(avg, k, n) for t, k, avg, n in items if t == "CATEGORY"]
    expected = []
    for section, found, limit in ((1, products, 2), (3, categories, None)):
        by_rating = sorted(found, reverse=True)[:limit]
        by_popularity = sorted(found, key=lambda x: (-x[2], x[1]))[:limit]
        for number, ordered in ((section, by_rating), (section + 1, by_popularity)):
            expected += [(number, rank, k, avg, n) for rank, (avg, k, n) in enumerate(ordered, 1)]
    ours = [(r.section_no, r.rank, r.item_key, r.avg_rating, r.review_count) for r in lists]
    assert sorted(ours) == sorted(expected)


@spark_settings
@given(st.lists(st.lists(EVENT, min_size=1, max_size=20), min_size=1, max_size=4))
def test_merged_partials_equal_the_whole(spark, days):
    keys = ["product_id"]
    parts = [ratings.partial_ratings(review_frame(spark, day), keys) for day in days]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    merged = ratings.finish(ratings.merge_partials(union, keys))
    whole = ratings.rating_stats(review_frame(spark, [e for day in days for e in day]), keys)
    shown = ["product_id", "avg_rating", "review_count"]
    assert sorted(map(tuple, merged.select(shown).collect())) == sorted(map(tuple, whole.select(shown).collect()))


def test_zero_ratings_count_except_in_the_sample_job(spark, rows):
    df = spark.createDataFrame([("p", 0.0), ("p", 4.0), ("", 3.0), (None, 3.0)], "product_id string, rating double")
    assert rows(ratings.product_ratings(df), "product_id", "avg_rating", "review_count") == [("p", 2.0, 2)]
    assert rows(ratings.sample_job(df), "product_id", "avg_rating", "review_count") == [("p", 4.0, 1)]


def test_nan_does_not_spoil_a_mean(spark, rows):
    df = spark.createDataFrame(
        [("p", 4.0, "c"), ("p", float("nan"), "c")], "product_id string, rating double, category string"
    )
    assert rows(ratings.tagged_ratings(df), *SHOWN) == [("CATEGORY", "c", 4.0, 1), ("PRODUCT", "p", 4.0, 1)]
    assert rows(prepare.rating_pairs(df)) == [("p", 4.0)]


def test_weighted_mean(spark, rows):
    df = spark.createDataFrame(
        [("x", 5.0, 1), ("x", 1.0, 3), ("y", None, 9), ("z", 4.0, 0)], "k string, rating double, rating_number bigint"
    )
    assert rows(ratings.weighted_ratings(df, ["k"])) == [("x", 2.0, 4, 2), ("z", None, 0, 1)]


@pytest.mark.parametrize("hot", [0.34, 0.9])
def test_a_hot_key_is_combined_before_the_shuffle(spark, hot):
    """A key with much of the data reaches the shuffle as one row per map task."""
    n = 200_000
    df = spark.range(0, n, 1, 16).select(
        F.when(F.col("id") < n * hot, F.lit("hot")).otherwise(F.concat(F.lit("p"), F.col("id") % 50)).alias("product_id"),
        F.lit("c").alias("category"),
        (F.lit(1) + F.col("id") % 5).cast("double").alias("rating"),
    )
    tagged = ratings.tagged_ratings(df).collect()
    counts = {(r.item_type, r.item_key): r.review_count for r in tagged}
    assert counts["PRODUCT", "hot"] == int(n * hot) and counts["CATEGORY", "c"] == n
    plan = ratings.product_ratings(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "partial_count" in plan


def test_lists_keep_rows_without_a_dataset(spark):
    df = spark.createDataFrame(
        [(None, "p", 4.0, "c"), ("d", "q", 3.0, "c"), (None, "r", 2.0, "e")],
        "dataset string, product_id string, rating double, category string",
    )
    lists = top_lists(df, min_reviews=1, by=["dataset"]).filter("section_no = 3").collect()
    assert sorted((str(r.dataset), r.rank, r.item_key) for r in lists) == [("None", 1, "c"), ("None", 2, "e"), ("d", 1, "c")]


def test_whole_lists_are_numbered_over_many_bands(spark):
    data = [("CATEGORY", f"c{i}", 1 + i % 401 / 100, i * i % 977 + 1) for i in range(3000)]
    tagged = spark.createDataFrame(
        data, "item_type string, item_key string, avg_rating double, review_count bigint"
    )
    by_rating = sorted(data, key=lambda x: (x[2], x[1]), reverse=True)
    assert [r.item_key for r in topk.categories_by_rating(tagged).orderBy("rank").collect()] == [x[1] for x in by_rating]
    by_popularity = sorted(data, key=lambda x: (-x[3], x[1]))
    ranks = topk.categories_by_popularity(tagged).orderBy("rank").collect()
    assert [(r.rank, r.item_key) for r in ranks] == [(i, x[1]) for i, x in enumerate(by_popularity, 1)]
