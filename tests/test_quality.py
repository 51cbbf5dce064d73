import pytest
from pyspark.sql import functions as F

from reviewlens.operators import quality


@pytest.fixture
def data(spark):
    return spark.createDataFrame(
        [("a", "p", 4.0, 10, "x"), ("a", None, 2.0, 20_000, "y"), ("b", "q", None, None, "x")],
        "dataset string, product_id string, rating double, review_length int, category string",
    )


def test_missing_profile(data, rows):
    assert rows(quality.missing_profile(data, ["dataset"])) == [
        ("a", "category", 0, 0.0), ("a", "product_id", 1, 50.0), ("a", "rating", 0, 0.0),
        ("a", "review_length", 0, 0.0), ("b", "category", 0, 0.0), ("b", "product_id", 0, 0.0),
        ("b", "rating", 1, 100.0), ("b", "review_length", 1, 100.0),
    ]


def test_profile_is_one_pass(data):
    plan = quality.missing_profile(data)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("Scan ExistingRDD") == 1


def test_empty_input_has_no_shares_and_fails(spark, data):
    empty = data.limit(0)
    assert {r.missing_pct for r in quality.missing_profile(empty).collect()} == {None}
    assert quality.outlier_share(empty).first().outlier_pct is None
    report = quality.validation_report(empty, expected=["a"]).first()
    assert (report.total_records, report.validation_status) == (0, "Failed")


def test_report_and_rollup(data):
    report = {r.dataset: r for r in quality.validation_report(data, expected=["a", "b", "c"]).collect()}
    assert {k: r.validation_status for k, r in report.items()} == {"a": "Passed", "b": "Passed", "c": "Failed"}
    a = report["a"]
    assert (a.total_records, a.min_rating, a.max_rating, a.avg_rating) == (2, 2.0, 4.0, 3.0)
    assert a.stddev_rating == pytest.approx(2**0.5) and a.outlier_count == 1
    rollup = quality.validation_rollup(quality.validation_report(data, expected=["a", "b", "c"])).first()
    assert tuple(rollup) == (3, 2, 1, 3)


def test_unexpected_datasets_are_reported_too(data):
    report = quality.validation_report(data, expected=["a", "c"])
    assert {r.dataset: r.validation_status for r in report.collect()} == {"a": "Passed", "b": "Passed", "c": "Failed"}


def test_report_without_length_column(data):
    assert "min_length" not in quality.validation_report(data.drop("review_length")).columns


def test_step_counts_ride_on_the_write(spark, data):
    written = []

    def sink(df):
        written.append(sorted(r.product_id or "" for r in df.collect()))

    counts = quality.step_counts(data, lambda df: df.filter(F.col("rating").isNotNull()), sink)
    assert tuple(counts.first()) == (3, 2, 1) and written == [["", "p"]]
