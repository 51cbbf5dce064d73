import datetime
import math
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from reviewlens.operators import bias, charts, stats, trends
from reviewlens.plans.analysis import analyze, save_analysis
from reviewlens.sources import read_results

spark_settings = settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
REVIEW = "dataset string, rating double, timestamp date, review_length int"


def reviews(spark, data):
    return spark.createDataFrame(
        [(d, r, datetime.date.fromisoformat(t) if t else None, n) for d, r, t, n in data], REVIEW
    )


@pytest.fixture
def data(spark):
    return reviews(
        spark,
        [
            ("a", 1.0, "2020-01-05", 50), ("a", 2.0, "2020-01-20", 150), ("a", 4.0, "2020-02-01", 400),
            ("a", 5.0, "2020-05-01", 1000), ("b", 3.0, "2021-01-01", 250), ("b", 4.0, None, 700),
            ("b", 2.5, "2021-01-02", None),
        ],
    )


def test_rolling_mean_skips_gaps_unless_by_calendar(data):
    partials = trends.monthly_partials(data.filter("dataset = 'a'"))
    rolled = [r.rolling_avg for r in trends.rolling(partials).orderBy("year", "month").collect()]
    assert rolled == pytest.approx([1.5, 2.75, 3.5])
    calendar = trends.rolling(partials, calendar=True).orderBy("year", "month").collect()
    assert [r.rolling_avg for r in calendar] == pytest.approx([1.5, 2.75, 5.0])


def test_seasonality_and_years(data, rows):
    partials = trends.monthly_partials(data)
    assert rows(trends.yearly(partials)) == [(2020, 3.0, 4), (2021, 2.75, 2)]
    assert rows(trends.seasonality(partials)) == [(1, 2.125, 4), (2, 4.0, 1), (5, 5.0, 1)]


def test_pivot_has_every_bucket_in_order(data):
    pivot = bias.rating_pivot(bias.length_partials(data))
    assert pivot.columns == ["rating_rounded", "Very Short", "Short", "Medium", "Long", "Very Long"]
    by_star = {r.rating_rounded: tuple(r)[1:] for r in pivot.collect()}
    assert by_star == {
        1: (1, 0, 0, 0, 0), 2: (0, 1, 0, 0, 0), 3: (0, 1, 0, 0, 0), 4: (0, 0, 1, 1, 0), 5: (0, 0, 0, 0, 1),
    }
    stacked = charts.stacked_chart(pivot).filter("rating_rounded = 4").collect()
    assert [r.bottom for r in stacked] == [0, 0, 0, 1, 2]


def test_bundle_agrees_with_the_single_analyses(data, rows):
    bundle = analyze(data, "dataset", "both")
    single = {
        "trends": trends.rating_trends(data, by=["dataset"]),
        "bias": bias.length_bias(data, by=["dataset"]),
        "stats": stats.rating_distribution(data, by=["dataset"]),
    }
    whole = {
        "trends": trends.rating_trends(data),
        "bias": bias.length_bias(data),
        "stats": stats.rating_distribution(data),
    }

    def close(ours, theirs):
        assert len(ours) == len(theirs)
        for a, b in zip(ours, theirs):
            for x, y in zip(a, b):
                assert x == (pytest.approx(y) if isinstance(y, float) else y)

    for analysis, frames in single.items():
        for name, frame in frames.items():
            result = bundle[analysis][name]
            columns = [c for c in frame.columns if c != "dataset"]
            close(rows(result.filter("dataset <> 'both'"), "dataset", *columns), rows(frame, "dataset", *columns))
            close(rows(result.filter("dataset = 'both'"), *columns), rows(whole[analysis][name], *columns))


def test_nan_is_no_rating(spark, data, rows):
    spoiled = data.unionByName(reviews(spark, [("a", float("nan"), "2020-01-05", 500)]))
    for ours, theirs in ((rating_frames(spoiled), rating_frames(data)),):
        for name, frame in ours.items():
            assert rows(frame) == rows(theirs[name]), name
    assert rows(analyze(spoiled, "dataset")["stats"]["basic_stats"]) == rows(analyze(data, "dataset")["stats"]["basic_stats"])


def rating_frames(df):
    return {**trends.rating_trends(df), **bias.length_bias(df), **stats.rating_distribution(df)}


def test_constant_columns_have_no_correlation(spark):
    same = reviews(spark, [("a", 3.0, "2020-01-01", n) for n in (10, 20, 30)])
    assert analyze(same, "dataset")["bias"]["correlation"].first().correlation is None
    assert bias.length_bias(same)["correlation"].first().correlation is None


@spark_settings
@given(st.lists(st.tuples(st.integers(10, 50), st.integers(0, 2000)), min_size=2, max_size=50))
def test_bundle_numbers_equal_plain_python(spark, pairs):
    data = reviews(spark, [("a", r / 10, "2020-01-01", n) for r, n in pairs])
    bundle = analyze(data, "dataset")
    ratings, lengths = [r / 10 for r, _ in pairs], [n for _, n in pairs]
    row = bundle["stats"]["basic_stats"].first()
    assert row["count"] == len(pairs)
    assert row.mean == pytest.approx(statistics.fmean(ratings))
    assert row.stddev == pytest.approx(statistics.stdev(ratings), abs=1e-6)
    quartiles = statistics.quantiles(ratings, n=4, method="inclusive")
    assert [row.q1, row.median, row.q3] == pytest.approx(quartiles)
    correlation = bundle["bias"]["correlation"].first().correlation
    if len(set(ratings)) == 1 or len(set(lengths)) == 1:
        assert correlation is None
    else:
        assert correlation == pytest.approx(statistics.correlation(lengths, ratings), abs=1e-6)
    assert sum(r["count"] for r in bundle["stats"]["histogram"].collect()) == len(pairs)
    assert sum(r.percentage for r in bundle["stats"]["star_distribution"].collect()) == pytest.approx(100)


@spark_settings
@given(st.lists(st.tuples(st.sampled_from("ab"), st.floats(-50, 50, allow_nan=False)), min_size=1, max_size=60))
def test_exact_quantiles_equal_plain_python(spark, pairs):
    rows = spark.createDataFrame(pairs, "g string, rating double")
    ours = {r.g: [r.q1, r.median, r.q3] for r in stats.exact_quantiles(rows, by=["g"]).collect()}
    for group in {g for g, _ in pairs}:
        values = [v for g, v in pairs if g == group]
        expected = statistics.quantiles(values, n=4, method="inclusive") if len(values) > 1 else values * 3
        assert ours[group] == pytest.approx(expected)


def test_single_rating_has_no_spread(spark):
    row = stats.basic_stats(stats.rating_counts(spark.sql("select 4.0D rating"))).first()
    assert (row["count"], row.median, row.stddev, row.iqr) == (1, 4.0, None, 0.0)


def test_chart_labels(data):
    box = charts.box_chart(stats.rating_distribution(data)["basic_stats"]).first()
    assert (box.min_label, box.max_label, len(box.box)) == ("Min: 1.00", "Max: 5.00", 5)
    bars = charts.bucket_chart(bias.length_bias(data)["bucket_stats"]).collect()
    assert [(b.bucket_ord, b.label) for b in bars] == [(1, "n=1"), (2, "n=2"), (3, "n=1"), (4, "n=1"), (5, "n=1")]
    stars = charts.star_chart(stats.rating_distribution(data)["star_distribution"]).collect()
    assert [s.label for s in stars] == ["14.3%", "14.3%", "28.6%", "28.6%", "14.3%"]
    dates = [str(r.date) for r in charts.monthly_chart(trends.rating_trends(data)["monthly"]).collect()]
    assert dates == ["2020-01-01", "2020-02-01", "2020-05-01", "2021-01-01"]


def test_saved_results_and_reports(spark, data, tmp_path, rows):
    bundle = analyze(data, "dataset", "both")
    assert save_analysis(bundle, f"{tmp_path}/both", "both") == {}
    yearly = read_results(spark, f"{tmp_path}/*/trends/yearly_json")
    assert rows(yearly, "dataset", "year", "review_count") == [("both", 2020, 4), ("both", 2021, 2)]
    lines = [r.value for r in spark.read.text(f"{tmp_path}/both/stats/basic_stats_summary", wholetext=True).collect()]
    text = lines[0].splitlines()
    assert text[:3] == ["Ratings Distribution Statistics", "=" * 30, "Count: 7"]
    assert text[5].startswith("Mean: 3.07") and len(text) == 11
    line = spark.read.text(f"{tmp_path}/both/bias/correlation").first().value
    assert line.startswith("Correlation between review length and rating: 0.9")


def test_one_failing_analysis_does_not_stop_the_others(spark, data, tmp_path):
    results = analyze(data, "dataset")
    results["bias"] = {"broken": spark.sql("select raise_error('no') as dataset")}
    errors = save_analysis(results, str(tmp_path))
    assert set(errors) == {"bias"}
    assert (tmp_path / "stats" / "histogram_json").exists()


def test_math_of_large_counts():
    """The centred sums lose no digits that matter on a rating scale."""
    n = 10**12
    deviation, squares = -0.1 * n, (0.01 + 1.2) * n
    assert math.isclose((squares - deviation * deviation / n) / (n - 1), 1.2, rel_tol=1e-9)
