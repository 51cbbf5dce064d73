import json

import pytest

from reviewlens.__main__ import main


@pytest.fixture
def raw(tmp_path):
    path = tmp_path / "raw.json"
    with path.open("w") as out:
        for i in range(40):
            record = {
                "parent_asin": f"p{i % 8}",
                "average_rating": 1 + i % 5,
                "description": ["some", "text" * (i % 3)],
                "details": json.dumps({"Date First Available": f"March {1 + i % 28}, 2019"}),
            }
            out.write(json.dumps(record) + "\n")
    return str(path)


def test_raw_data_to_top_lists(spark, tmp_path, raw, capsys):
    assert not main(["preprocess", f"Electronics={raw}", "--output", f"{tmp_path}/processed"], spark)
    table = f"electronics={tmp_path}/processed/dataset=electronics"
    main(["validate", table, "--output", f"{tmp_path}/validation"], spark)
    assert spark.read.json(f"{tmp_path}/validation").first().validation_status == "Passed"
    counts = main(["prepare", table, "--output", f"{tmp_path}/prepared"], spark)
    assert counts["electronics"] == {"product_ratings": 40, "time_analysis": 40, "review_length": 40}
    pairs = f"electronics={tmp_path}/prepared/electronics_product_ratings"
    main(["top", pairs, "--pairs", "--output", f"{tmp_path}/top"], spark)
    assert "TOP_CATEGORIES_BY_RATING" in capsys.readouterr().out
    main(["sample", table, "--output", f"{tmp_path}/sample"], spark)
    assert spark.read.schema("rating double").json(f"{tmp_path}/sample").count() < 40
    assert spark.read.json(f"{tmp_path}/validation_rating_frequency").count() == 5
    outcome = main(["convert", table, f"gone={tmp_path}/gone", "--output", f"{tmp_path}/formats"], spark)
    assert outcome["gone"] == "missing" and spark.read.json(outcome["electronics_json"]).count() == 40


def test_analysis_of_datasets_and_their_combination(spark, tmp_path):
    for name, shift in (("a", 0), ("b", 1)):
        spark.range(100).selectExpr(
            "concat('p', id % 9) product_id", "'c' category", f"cast(1 + (id + {shift}) % 5 as double) rating",
            "date_add(date '2020-01-01', cast(id as int)) timestamp", "cast(id * 10 as int) review_length",
        ).write.parquet(f"{tmp_path}/{name}")
    inputs = [f"{name}={tmp_path}/{name}" for name in "ab"]
    assert not main(["analyze", *inputs, "--output", f"{tmp_path}/out"], spark)
    both = spark.read.json(f"{tmp_path}/out/all_categories/stats/basic_stats_json").first()
    assert both["count"] == 200
    report = spark.read.parquet(f"{tmp_path}/out/integrated_report")
    assert {r[0] for r in report.select("dataset").distinct().collect()} == {"a", "b", "all_categories"}


def test_stream_job_takes_up_where_it_stopped(spark, tmp_path, rows):
    def arrive(rating, mode):
        df = spark.sql(f"select 'p' product_id, {rating}D rating, timestamp'2024-01-01 10:00:00' timestamp")
        df.write.mode(mode).parquet(f"{tmp_path}/in")
        main(["stream", f"x={tmp_path}/in", "--output", f"{tmp_path}/out"], spark)
        return rows(spark.read.parquet(f"{tmp_path}/out/x/daily"), "product_id", "avg_rating", "review_count")

    assert arrive(4, "overwrite") == [("p", 4.0, 1)]
    assert arrive(1, "append") == [("p", 2.5, 2)]


def test_profile_and_inventory_print(spark, raw, capsys):
    main(["profile", f"x={raw}"], spark)
    main(["inventory", f"x={raw}"], spark)
    shown = capsys.readouterr().out
    assert "object_lines" in shown and "raw.json" in shown


def test_scripts_as_mapper_and_reducer(spark, tmp_path, capsys):
    (tmp_path / "words_map.py").write_text(
        "import sys\nfor line in sys.stdin:\n    for w in line.split():\n        print(w + '\\t1')\n"
    )
    (tmp_path / "words_reduce.py").write_text(
        "import sys, itertools\n"
        "pairs = (line.rstrip('\\n').split('\\t') for line in sys.stdin)\n"
        "for word, group in itertools.groupby(pairs, lambda p: p[0]):\n"
        "    print(word + '\\t' + str(sum(int(n) for _, n in group)))\n"
    )
    (tmp_path / "in").mkdir()
    for i in range(3):
        (tmp_path / "in" / f"{i}.txt").write_text("a b a\nc a\n" * 10)
    scripts = ["--mapper", f"{tmp_path}/words_map.py", "--reducer", f"{tmp_path}/words_reduce.py"]
    inputs = [f"words={tmp_path}/in", "--output", f"{tmp_path}/out"]
    for extra in ([], ["--combiner", f"{tmp_path}/words_reduce.py", "--partitions", "2"]):
        main(["mapreduce", *inputs, *scripts, *extra], spark)
        counted = sorted(r.value for r in spark.read.text(f"{tmp_path}/out/words").collect())
        assert counted == ["a\t90", "b\t30", "c\t30"]
    assert "output_lines" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["mapreduce", *inputs], spark)


def test_arguments_are_checked(spark, raw):
    with pytest.raises(SystemExit):
        main(["top", f"x={raw}"], spark)
    with pytest.raises(SystemExit):
        main(["top", raw, "--output", "x"], spark)
