"""Rounding, bands and quantiles by radix selection."""

import math
import random
import re
import statistics
import struct

import pytest
from pyspark.sql import functions as F

from reviewlens.functions import band, rounded
from reviewlens.operators import stats
from reviewlens.operators.quantiles import exact_quantiles
from reviewlens.plans.analysis import analyze, review_summary

INF = float("inf")


def doubles(seed, count):
    pick = random.Random(seed)
    odd = [0.0, -0.0, 5e-324, -5e-324, 1e-310, 2.0**-1022, 1.7976931348623157e308, INF, -INF, 0.1, 1.0]
    odd += [sign * 2.0**e for e in range(-1074, 1024) for sign in (1, -1)]
    odd += [struct.unpack("d", struct.pack("Q", pick.getrandbits(64)))[0] for _ in range(count)]
    return [x for x in odd if x == x]


@pytest.mark.parametrize("bits", [7, 13, 24, 53])
def test_rounding_keeps_the_order_and_the_first_bits(spark, bits):
    rows = spark.createDataFrame([(x,) for x in doubles(1, 5000)], "x double")
    got = sorted((r.x, r.t) for r in rows.select("x", rounded(F.col("x"), bits).alias("t")).collect())
    assert all(a[1] <= b[1] for a, b in zip(got, got[1:], strict=False))
    for x, t in got:
        if math.isinf(x) or math.isinf(t):
            assert x == t or abs(x) > 2.0**1023
            continue
        mantissa, exponent = math.frexp(x)
        assert abs(t - x) <= math.ldexp(0.5, exponent - bits) or abs(x) < 2.0**-1000, (x, t)
        assert math.frexp(t)[0] * 2**bits % 1 == 0 or abs(x) < 2.0**-1000, (x, t)


def test_bands_keep_short_decimals_and_halves_apart(spark):
    values = [i / 100 for i in range(1000)] + [i / 2 for i in range(2000)]
    rows = spark.createDataFrame([(x,) for x in values], "x double").distinct()
    held = rows.groupBy(band(F.col("x")).alias("band")).agg(F.count("*").alias("n")).filter("n > 1").collect()
    assert held == []
    near = spark.range(100000).select((3.5 + (F.col("id") - 50000) / 1e6).alias("x"))
    mixed = near.groupBy(band(F.col("x")).alias("band")).agg(F.min("x").alias("a"), F.max("x").alias("b"))
    assert mixed.filter("a < 3.5 and b >= 3.5").collect() == []


@pytest.mark.parametrize("weighted", [False, True])
def test_values_of_every_size_in_groups(spark, weighted):
    pick = random.Random(2)
    groups = {
        "wide": doubles(3, 300),
        "near": [1 + pick.randrange(5000) * 2.0**-52 for _ in range(999)],  # all alike in their first 48 bits
        "ties": [2.5] * 700 + [pick.random() for _ in range(300)],
        None: [7.25],
        "two": [-1.0, 1.0],
    }
    groups["wide"] = [x for x in groups["wide"] if abs(x) < 1e300]
    rows = [(g, x, 3 if weighted and i % 2 else 1) for g, values in groups.items() for i, x in enumerate(values)]
    rows += [("wide", None, 1), ("near", float("nan"), 1), ("none", None, 1)]
    df = spark.createDataFrame(rows, "g string, x double, n int").repartition(6)
    wanted = {"low": 0.0, "third": 1 / 3, "median": 0.5, "high": 1.0}
    got = {r.g: r for r in exact_quantiles(df, wanted, ["g"], "x", "n").collect()}
    assert set(got) == set(groups)
    for g in groups:
        values = sorted(x for h, x, n in rows if h == g and x is not None and x == x for _ in range(n))
        for name, p in wanted.items():
            at = p * (len(values) - 1)
            low, high = values[int(at)], values[min(int(at) + 1, len(values) - 1)]
            expected = low if at == int(at) else low + (high - low) * (at - int(at))
            assert got[g][name] == pytest.approx(expected, rel=1e-12, abs=1e-320), (g, name)


def test_no_rows_and_only_counters_are_shuffled(spark):
    df = spark.createDataFrame([], "g string, x double")
    assert exact_quantiles(df, by=["g"], value="x").collect() == []
    rows = spark.range(200000, numPartitions=4).select((F.col("id") * 0.37 % 1000).alias("rating"))
    row = exact_quantiles(rows).first()
    values = sorted(i * 0.37 % 1000 for i in range(200000))
    assert row.asDict() == pytest.approx(dict(zip(["q1", "median", "q3"], statistics.quantiles(values, n=4, method="inclusive"), strict=True)))
    plan = stats.basic_stats(stats.rating_counts(rows))._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert not re.search(r"Join", plan)


def test_statistics_of_continuous_ratings_from_a_state_of_fixed_size(spark):
    pick = random.Random(4)
    rows = [(pick.uniform(1, 5), pick.randrange(1000), f"20{20 + i % 3}-0{1 + i % 9}-01") for i in range(6000)]
    df = spark.createDataFrame(rows, "rating double, review_length int, timestamp string").withColumn("timestamp", F.to_date("timestamp"))
    ratings = [r for r, _, _ in rows]
    exact = statistics.quantiles(ratings, n=4, method="inclusive")
    both = analyze(df)
    row, same = both["stats"]["basic_stats"].first(), stats.exact_stats(df).first()
    assert [same.q1, same.median, same.q3] == pytest.approx(exact)
    assert [row.q1, row.median, row.q3] == pytest.approx(exact, rel=1 / 8192)
    assert (row["count"], row.min, row.max) == (6000, min(ratings), max(ratings))
    assert row.stddev == pytest.approx(statistics.stdev(ratings)) and same.mean == pytest.approx(statistics.fmean(ratings))
    got = both["bias"]["correlation"].first().correlation
    assert got == pytest.approx(statistics.correlation(ratings, [n for _, n, _ in rows]), abs=1e-9)
    halves = {r.rating_bucket: r["count"] for r in both["stats"]["histogram"].collect()}
    assert halves == {k / 2: sum(int(2 * r) == k for r in ratings) for k in range(2, 10)}
    stars = {r.star_rating: r["count"] for r in both["stats"]["star_distribution"].collect()}
    assert stars == {k: sum(int(r + 0.5) == k for r in ratings) for k in range(1, 6)}
    # two and a third powers of two at 8192 bands each, however many ratings
    tenfold = df.withColumn("rating", F.explode(F.array([F.col("rating") * (1 - k / 1e6) for k in range(10)])))
    assert stats.rating_counts(tenfold).count() <= 3 * 8192
    assert review_summary(tenfold).columns == review_summary(df).columns
