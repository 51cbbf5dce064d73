"""Places in ordered lists."""

import re

from pyspark.sql import functions as F

from reviewlens.operators.places import numbered
from reviewlens.operators.topk import categories_by_popularity, categories_by_rating


def test_a_long_list_with_ties_is_spread_and_numbered_in_order(spark):
    """70 % of 60,000 rows share one score, and one list holds nearly all rows."""
    rows = spark.range(60000).select(
        F.when(F.col("id") % 1000 == 7, F.lit("small")).when(F.col("id") % 1000 != 8, F.lit("large")).alias("list"),
        F.when(F.col("id") % 10 < 7, F.lit(3.5)).otherwise(F.col("id") / 7).alias("score"),
        F.concat(F.lit("k"), F.col("id") * 7919 % 60000).alias("key"),
    )
    placed = numbered(rows.repartition(5), [F.desc("score"), F.desc("key")], ["list"], "place")
    got = {}
    for r in placed.collect():
        got.setdefault(r["list"], []).append((r["place"], r["score"], r["key"]))
    assert set(got) == {None, "small", "large"} and sum(map(len, got.values())) == 60000
    for found in got.values():
        found.sort()
        assert [place for place, _, _ in found] == list(range(1, len(found) + 1))
        assert [(s, k) for _, s, k in found] == sorted(((s, k) for _, s, k in found), reverse=True)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ids = rows.repartitionByRange("list", F.desc("score"), F.desc("key")).groupBy(F.spark_partition_id()).count()
        sizes = [r["count"] for r in ids.collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(sizes) < 2 * 60000 / len(sizes)


def test_one_list_no_rows_and_repeated_rows(spark):
    rows = spark.createDataFrame([(2,), (1,), (2,), (None,)], "v int")
    got = [(r["v"], r["rank"]) for r in numbered(rows, [F.desc_nulls_last("v")]).collect()]
    assert sorted(got, key=lambda x: x[1]) == [(2, 1), (2, 2), (1, 3), (None, 4)]
    assert numbered(rows.filter("v > 5"), [F.col("v")], ["v"]).collect() == []


def test_no_join_key_is_the_same_in_every_row(spark):
    tagged = spark.createDataFrame(
        [("CATEGORY", f"c{i}", 3.0 + i % 3, 3.0 + i % 3, i % 5) for i in range(50)],
        "item_type string, item_key string, avg_rating double, mean_rating double, review_count bigint",
    )
    for lists in (categories_by_rating(tagged), categories_by_popularity(tagged)):
        lists.collect()
        text = lists._jdf.queryExecution().executedPlan().toString()
        keys = re.findall(r"Join.*?\[([^\]]*)\]", text)
        assert keys and all("_stretch" in key for key in keys)
        assert "pmod" not in text and "hash(" not in text
