import gzip
import json

import pytest
from pyspark.sql import functions as F

from reviewlens import sinks, sources
from reviewlens.operators import prepare, ratings
from reviewlens.plans.datasets import preprocess
from reviewlens.plans.top_lists import top_job
from reviewlens.schemas import raw_schema


def text_of(path):
    return "\n".join(f.read_text() for f in sorted(path.glob("part-*")))


def test_json_keeps_nulls_and_arrays_and_has_no_nan(spark, tmp_path):
    df = spark.sql(
        "select cast(null as string) a, array(1, 2) b, double('nan') c, float('inf') d, 1Y e, true f, "
        "array(1.5D, double('nan')) g"
    )
    sinks.write_json(df, str(tmp_path / "out"), "gzip")
    (part,) = (tmp_path / "out").glob("part-*.json.gz")
    line = json.loads(gzip.open(part, "rt").read())
    assert line == {"a": None, "b": [1, 2], "c": None, "d": None, "e": 1, "f": True, "g": [1.5, None]}


def test_csv_has_header_and_nested_values_as_json(spark, tmp_path):
    df = spark.sql("select 'a,\"b\"' t, array(1, 2) n, 5 i")
    sinks.write_csv(df, str(tmp_path / "out"))
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "out")).first()
    assert tuple(back) == ('a,"b"', "[1,2]", "5")


def test_parquet_partitions_are_pruned(spark, tmp_path):
    df = spark.sql("select 'x' category, 1 v union all select 'y', 2")
    sinks.write_parquet(df, str(tmp_path / "out"), ["category"])
    read = spark.read.parquet(str(tmp_path / "out")).filter("category = 'x'")
    assert read.count() == 1
    assert "PartitionFilters: [isnotnull(category" in read._jdf.queryExecution().executedPlan().toString()


def test_nothing_is_written_for_no_rows(spark, tmp_path):
    target = str(tmp_path / "out")
    empty = spark.range(0)
    assert sinks.write_if_any(empty, lambda df: sinks.write_json(df, target)) == 0
    assert not (tmp_path / "out").exists()
    assert sinks.write_if_any(spark.range(5), lambda df: sinks.write_json(df, target)) == 5


def test_aggregate_lines(spark, tmp_path, rows):
    tagged = spark.createDataFrame(
        [("PRODUCT", "p", 4.0, 2), ("CATEGORY", "toys", 1.5, 2)],
        "item_type string, item_key string, avg_rating double, review_count bigint",
    )
    sinks.write_aggregate_lines(tagged, str(tmp_path / "out"))
    assert sorted(text_of(tmp_path / "out").split()) == sorted("p 4.00 2 CATEGORY_toys 1.50 2".split())
    (tmp_path / "lines.tsv").write_text("p\t4.00\t2\nbad\nq\tx\t3\nCATEGORY_toys\t1.50\t2\na\t1.0\t2\t3\n")
    back = prepare.route_keys(sources.read_aggregate_lines(spark, str(tmp_path / "lines.tsv")))
    assert rows(back, "item_type", "item_key", "avg_rating") == [("CATEGORY", "toys", 1.5), ("PRODUCT", "p", 4.0)]


def test_report_text_and_back(spark, tmp_path, rows):
    data = spark.createDataFrame(
        [(f"p{i % 12:02d}", 1.0 + i % 5, f"c{i % 3}") for i in range(120)],
        "product_id string, rating double, category string",
    )
    lists = top_job(data, str(tmp_path))
    text = text_of(tmp_path / "report").rstrip("\n").split("\n")
    assert text[0] == "TOP_PRODUCTS_BY_RATING" and text[11] == "" and text[12] == "TOP_PRODUCTS_BY_POPULARITY"
    assert text[1].split("\t")[0] == "1" and len(text[1].split("\t")) == 4
    back = sources.read_report(spark, str(tmp_path / "report"))
    shown = ["section", "rank", "item_key", "avg_rating", "review_count"]
    assert rows(back, *shown) == rows(lists, *shown)
    only = sources.read_report(spark, str(tmp_path / "report"), ["TOP_PRODUCTS_BY_RATING"])
    assert only.count() == 10
    routed = prepare.route_keys(sources.read_aggregate_lines(spark, str(tmp_path / "aggregates")))
    assert routed.count() == ratings.tagged_ratings(data).count()


def test_empty_report_still_has_its_titles(spark, tmp_path):
    empty = spark.createDataFrame([], "product_id string, rating double, category string")
    top_job(empty, str(tmp_path))
    assert text_of(tmp_path / "report").split("\n")[:7] == [
        "TOP_PRODUCTS_BY_RATING", "", "TOP_PRODUCTS_BY_POPULARITY", "", "TOP_CATEGORIES_BY_RATING", "",
        "TOP_CATEGORIES_BY_POPULARITY",
    ]
    assert sources.read_report(spark, str(tmp_path / "report")).count() == 0


def test_json_pairs_skip_bad_lines(spark, tmp_path, rows):
    (tmp_path / "raw.json").write_text(
        '{"parent_asin": "a\\tb", "average_rating": 4.5}\n{"parent_asin": "c", "average_rating": "3"}\n'
        'not json\n{"parent_asin": "d"}\n{"average_rating": 1}\n{"parent_asin": "e", "average_rating": "x"}\n'
    )
    assert rows(sources.read_json_pairs(spark, str(tmp_path / "raw.json"))) == [("a b", 4.5), ("c", 3.0)]


def test_gz_source_is_spread(spark, tmp_path):
    with gzip.open(tmp_path / "raw.json.gz", "wt") as out:
        for i in range(100):
            out.write(json.dumps({"parent_asin": f"p{i}", "average_rating": 4.0}) + "\n")
    df = sources.read_raw_products(spark, str(tmp_path / "raw.json.gz"), "Electronics", partitions=4)
    assert df.rdd.getNumPartitions() == 4 and df.filter("category = 'Electronics'").count() == 100


def test_preprocess_writes_what_it_can(spark, tmp_path, rows):
    (tmp_path / "a.json").write_text('{"parent_asin": "p", "average_rating": 4.0, "description": ["x", "y"]}\n')
    errors = preprocess(
        spark, {"Toys_Games": str(tmp_path / "a.json"), "Gone": str(tmp_path / "no.json")}, str(tmp_path / "out")
    )
    assert list(errors) == ["Gone"]
    out = spark.read.parquet(str(tmp_path / "out"))
    assert rows(out, "dataset", "category", "product_id", "description") == [("toys_games", "Toys_Games", "p", "x y")]


def test_ids_and_ratings_follow_the_columns_a_file_has(spark, tmp_path, rows):
    (tmp_path / "old.json").write_text('{"asin": "b", "overall": 3, "price": 9.5}\n{"asin": "c"}\n')
    (tmp_path / "both.json").write_text('{"asin": "x", "parent_asin": "p"}\n{"asin": "y", "parent_asin": null}\n')
    (tmp_path / "bare.json").write_text('{"title": "t", "details": {"Date First Available": "May 1, 2020"}}\n')
    inputs = {name: str(tmp_path / f"{name}.json") for name in ("old", "both", "bare")}
    known = {"old": raw_schema("asin", "overall", "price")}
    for schemas in (None, known):
        assert not preprocess(spark, inputs, str(tmp_path / "out"), schemas=schemas)
        out = spark.read.parquet(str(tmp_path / "out"))
        assert rows(out, "dataset", "product_id", "rating") == sorted(
            [("old", "b", 3.0), ("old", "c", None), ("both", "p", None), ("both", None, None), ("bare", "unknown", None)],
            key=repr,
        )
        assert [str(r.review_date) for r in prepare.time_extract(out).collect()] == ["2020-05-01"]


def test_json_profile(spark, tmp_path):
    (tmp_path / "lines.json").write_text('{"b": 1, "a": 2}\nbroken\n[1, 2, 3]\n{"c": 1}\n\n')
    row = sources.json_profile(spark, str(tmp_path / "lines.json")).first()
    assert (row.line_count, row.object_lines, row.array_lines, row.invalid_lines) == (4, 2, 1, 1)
    assert (row.first_keys, row.array_items) == (["b", "a"], 3)


def test_inventory_reads_no_content(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"x" * 10)
    found = sources.file_inventory(spark, str(tmp_path), ["a.bin", "b.bin"])
    assert {r.name: (r.present, r.bytes) for r in found.collect()} == {"a.bin": (True, 10), "b.bin": (False, None)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema:")[1].splitlines()[0]


def test_dataset_inventory_reports_the_unreadable(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "good"))
    found = sources.dataset_inventory(spark, {"good": str(tmp_path / "good"), "bad": str(tmp_path / "bad")})
    by_name = {r.dataset: r for r in found.collect()}
    assert (by_name["good"].readable, by_name["good"].row_count) == (True, 3)
    assert not by_name["bad"].readable and "PATH_NOT_FOUND" in by_name["bad"].error


def test_no_source_fails_loudly(spark, tmp_path):
    absent = lambda: spark.read.parquet(str(tmp_path / "absent"))
    with pytest.raises(ValueError, match="no readable source"):
        sources.first_readable([("table", absent)])
    chosen = sources.first_readable([("table", absent), ("made", lambda: spark.range(1))])
    assert chosen.first().source == "made"


def test_export_skips_missing_inputs(spark, tmp_path):
    spark.range(3).withColumn("a", F.array("id")).write.parquet(str(tmp_path / "in"))
    outcome = sinks.export(spark, {"x": str(tmp_path / "in"), "y": str(tmp_path / "no")}, str(tmp_path / "out"))
    assert outcome["y"] == "missing"
    assert spark.read.json(outcome["x_json"]).count() == 3
    assert spark.read.option("header", True).csv(outcome["x_csv"]).columns == ["id", "a"]


def test_files_of_a_folder_carry_their_names(spark, tmp_path):
    spark.range(0, 10, 1, 2).write.parquet(str(tmp_path / "in"))
    names = [r[0] for r in sources.read_parquet_dir(spark, str(tmp_path / "in")).select("file_name").distinct().collect()]
    assert len(names) == 2 and all(n.startswith("part-") for n in names)


def broken(path):
    path.mkdir()
    (path / "x.parquet").write_bytes(b"not a table at all")
    return str(path)


def test_a_corrupt_file_stops_no_other_dataset(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "good"))
    inputs = {"bad": broken(tmp_path / "bad"), "good": str(tmp_path / "good"), "gone": str(tmp_path / "gone")}
    frames, errors = sources.read_processed(spark, inputs)
    assert set(frames) == {"good"} and set(errors) == {"bad", "gone"}
    found = {r.dataset: (r.readable, r.row_count) for r in sources.dataset_inventory(spark, inputs).collect()}
    assert found == {"bad": (False, None), "good": (True, 3), "gone": (False, None)}
    outcome = sinks.export(spark, inputs, str(tmp_path / "out"))
    assert outcome["gone"] == "missing" and outcome["bad"].startswith("error") and "good_csv" in outcome
    chosen = sources.first_readable([(name, lambda p=path: spark.read.parquet(p)) for name, path in inputs.items()])
    assert chosen.first().source == "good"


def test_a_failed_dataset_keeps_its_earlier_table(spark, tmp_path):
    from reviewlens.plans.datasets import preprocess

    for name in "ab":
        (tmp_path / f"{name}.json").write_text('{"parent_asin": "p", "average_rating": 3}\n')
    output, inputs = str(tmp_path / "out"), {name: str(tmp_path / f"{name}.json") for name in "ab"}
    assert preprocess(spark, inputs, output) == {}
    (tmp_path / "c.json.gz").write_bytes(b"junk, not gzip")
    inputs |= {"b": str(tmp_path / "gone"), "c": str(tmp_path / "c.json.gz")}
    assert set(preprocess(spark, inputs, output)) == {"b", "c"}
    assert sorted(r.dataset for r in spark.read.parquet(output).collect()) == ["a", "b"]
    assert set(preprocess(spark, {"b": str(tmp_path / "gone")}, output)) == {"b"}


def test_numbers_that_json_lacks_become_null_at_any_depth(spark, tmp_path):
    nan = "double('NaN')"
    df = spark.sql(f"select struct({nan} as x, 1 as y) a, array(struct({nan} as z)) b, map('k', {nan}) c, array({nan}) d")
    sinks.write_json(df, str(tmp_path / "out"))
    text = spark.read.text(str(tmp_path / "out")).first().value
    assert "NaN" not in text and text.count("null") == 4 and '"y":1' in text


def test_undefined_measures_in_reports(spark):
    row = spark.createDataFrame([(1, 2.0, None)], "count bigint, mean double, stddev double")
    row = row.selectExpr("*", *[f"mean as {name}" for name in ("min", "max", "median", "q1", "q3", "iqr")])
    lines = [r.value for r in sinks.stats_lines(row).orderBy("line_no").collect()]
    assert "Standard Deviation: undefined" in lines and "Mean: 2.00" in lines
    none = spark.createDataFrame([(None,)], "correlation double")
    assert sinks.correlation_line(none).first().value.endswith(": undefined")
    from reviewlens.operators.charts import correlation_chart

    assert correlation_chart(none).first().label == "undefined"


def test_dataset_names_with_spaces_and_plus(spark, tmp_path):
    spark.range(1).write.json(str(tmp_path / "toys + games" / "stats" / "x_json"))
    found = sources.read_results(spark, str(tmp_path / "*" / "stats" / "x_json"))
    assert found.first().dataset == "toys + games"


def test_report_rows_without_a_count(spark, tmp_path):
    (tmp_path / "r.txt").write_text("TOP_PRODUCTS_BY_RATING\n1\tp1\t4.50\n2\tp2\t4.00\t7\n")
    rows = sources.read_report(spark, str(tmp_path)).orderBy("rank").collect()
    assert [(r.item_key, r.review_count) for r in rows] == [("p1", None), ("p2", 7)]
