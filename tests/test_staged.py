"""Jobs over several datasets, some of which cannot be read to their end."""

import glob

import pytest

from reviewlens.__main__ import main
from reviewlens.plans.staged import list_datasets, sample_datasets, staged, validate_datasets


def write(spark, path, shift=0, rows=100):
    spark.range(rows).repartition(4).selectExpr(
        "concat('p', id % 9) product_id", "concat('c', id % 2) category", f"cast(1 + (id + {shift}) % 5 as double) rating",
        "date_add(date '2020-01-01', cast(id as int)) timestamp", "cast(id * 10 as int) review_length",
    ).write.parquet(path)


def spoil(path):
    """The middle of one part file overwritten: its footer is whole, its pages are not."""
    part = sorted(glob.glob(f"{path}/part-*.parquet"))[1]
    with open(part, "r+b") as file:
        file.seek(8)
        file.write(b"\xff" * 300)
    crc = part.replace("/part-", "/.part-") + ".crc"
    for sums in glob.glob(crc):
        open(sums, "wb").close()


@pytest.fixture
def datasets(spark, tmp_path):
    for name, shift in (("a", 0), ("b", 1), ("c", 2)):
        write(spark, f"{tmp_path}/{name}", shift)
    spoil(f"{tmp_path}/b")
    return [f"{name}={tmp_path}/{name}" for name in "abc"] + [f"gone={tmp_path}/gone"]


def test_a_fault_in_the_middle_of_a_file_stops_no_other_dataset(spark, tmp_path, datasets):
    outcome = main(["validate", *datasets, "--output", f"{tmp_path}/report"], spark)
    assert set(outcome["errors"]) == {"b", "gone"}
    report = {r.dataset: r for r in spark.read.json(f"{tmp_path}/report").collect()}
    assert {name: (r.validation_status, r.total_records) for name, r in report.items()} == {
        "a": ("Passed", 100), "c": ("Passed", 100), "b": ("Failed", 0), "gone": ("Failed", 0),
    }
    assert report["b"].error and report["a"].error is None and report["a"].avg_rating == 3.0
    counts = spark.read.json(f"{tmp_path}/report_category_frequency").collect()
    assert sorted((r.category, r["count"]) for r in counts) == [("c0", 100), ("c1", 100)]
    assert spark.read.json(f"{tmp_path}/report_rating_frequency").count() == 10


def test_analysis_of_what_can_be_read(spark, tmp_path, datasets):
    outcome = main(["analyze", *datasets, "--output", f"{tmp_path}/out"], spark)
    assert set(outcome["errors"]) == {"b", "gone"}
    both = spark.read.json(f"{tmp_path}/out/all_categories/stats/basic_stats_json").first()
    assert both["count"] == 200 and not glob.glob(f"{tmp_path}/out/b*")
    report = spark.read.parquet(f"{tmp_path}/out/integrated_report")
    assert {r[0] for r in report.select("dataset").distinct().collect()} == {"a", "c", "all_categories"}


def test_nothing_can_be_read(spark, tmp_path, datasets):
    for job in ("validate", "analyze", "sample"):
        outcome = main([job, datasets[1], datasets[3], "--output", f"{tmp_path}/{job}"], spark)
        assert set(outcome["errors"]) == {"b", "gone"}, job
    statuses = [r.validation_status for r in spark.read.json(f"{tmp_path}/validate").collect()]
    assert statuses == ["Failed", "Failed"] and not glob.glob(f"{tmp_path}/analyze*")


def test_empty_datasets_other_columns_and_samples(spark, tmp_path):
    write(spark, f"{tmp_path}/full")
    frames = {name: spark.read.parquet(f"{tmp_path}/full").selectExpr(f"'{name}' dataset", "*") for name in ("x", "y")}
    frames["y"] = frames["y"].drop("review_length").filter("false")
    results, errors = validate_datasets(spark, frames)
    assert errors == {}
    got = {r.dataset: r for r in results["validation_report"].collect()}
    assert (got["y"].validation_status, got["y"].total_records, got["x"].validation_status) == ("Failed", 0, "Passed")
    drawn, errors = sample_datasets(frames, 0.5, 7)
    again, _ = sample_datasets({"x": frames["x"].repartition(3)}, 0.5, 7)
    assert errors == {} and sorted(map(str, drawn.collect())) == sorted(map(str, again.select(drawn.columns).collect()))
    assert list_datasets({})[0] is None and staged({}, lambda name, df: df, "none") == ({}, {})
