"""Folders put in place whole, several sinks from one scan, rows without a JSON form."""

import glob
import json
import os

import pytest
from pyspark.errors import PySparkException

from reviewlens import sinks
from reviewlens.plans import datasets
from reviewlens.sinks import folders
from reviewlens.sources import read_processed


def values(spark, path):
    return sorted(r.id for r in spark.read.parquet(folders.current(spark, path)).collect())


def test_a_new_version_is_written_once_and_replaces_the_old(spark, tmp_path):
    path, written = f"{tmp_path}/table", []

    def write(df, target):
        written.append(target)
        sinks.write_parquet(df, target)

    for rows in (3, 5):
        folders.replace(spark.range(rows), path, write)
        assert values(spark, path) == list(range(rows)) and os.listdir(tmp_path) == ["table"]
    assert len(set(written)) == 2 and path not in written


def test_a_failed_write_changes_nothing(spark, tmp_path):
    path = f"{tmp_path}/table"
    folders.replace(spark.range(3), path, sinks.write_parquet)
    with pytest.raises(Exception, match="no"):
        folders.replace(spark.range(9).selectExpr("if(id = 8, raise_error('no'), id) id"), path, sinks.write_parquet)
    assert values(spark, path) == [0, 1, 2] and os.listdir(tmp_path) == ["table"]


@pytest.mark.parametrize("step", ["first", "second"])
def test_cut_off_between_the_renames_a_whole_version_is_read(spark, tmp_path, monkeypatch, step):
    path = f"{tmp_path}/dataset=x"
    folders.replace(spark.range(3), path, sinks.write_parquet)
    move, done = folders.Folders.move, []

    def crash(self, source, target):
        if step == "first" or done:
            raise RuntimeError("cut off")
        done.append(source)
        move(self, source, target)

    monkeypatch.setattr(folders.Folders, "move", crash)
    with pytest.raises(RuntimeError):
        folders.replace(spark.range(5), path, sinks.write_parquet)
    monkeypatch.undo()
    assert values(spark, path) == [0, 1, 2]
    frames, errors = read_processed(spark, {"x": path})
    assert errors == {} and frames["x"].count() == 3
    folders.replace(spark.range(7), path, sinks.write_parquet)
    assert values(spark, path) == list(range(7)) and "dataset=x" in os.listdir(tmp_path)
    if step == "second":
        assert not glob.glob(f"{tmp_path}/*previous*")


def test_three_extracts_from_one_scan(spark, tmp_path, rows):
    df = spark.createDataFrame(
        [("a\tb", 1.5, "c,1", 'say "x"', '{"Date First Available": "May 1, 2020"}'), ("b", None, "c", "", None), (None, 2.0, None, "text", None)],
        "product_id string, rating double, category string, description string, details string",
    )
    pairs = rows(df.filter("product_id is not null and rating is not null").select("product_id", "rating"))
    stages = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("prepare", "one job")
    counts = datasets.prepare(df, f"{tmp_path}/x")
    assert len(stages.getJobIdsForGroup("prepare")) == 1
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts == {"product_ratings": 1, "time_analysis": 1, "review_length": 2}
    read = lambda name, schema: rows(spark.read.schema(schema).option("sep", "\t").csv(f"{tmp_path}/x_{name}"))
    assert read("product_ratings", "p string, r double") == pairs
    assert [tuple(map(str, r)) for r in read("time_analysis", "p string, d date, r double, c string")] == [("a\tb", "2020-05-01", "1.5", "c,1")]
    assert read("review_length", "p string, n int, r double, c string") == sorted([("a\tb", 7, 1.5, "c,1"), (None, 4, 2.0, None)], key=repr)
    assert not glob.glob(f"{tmp_path}/_*")
    assert datasets.prepare(df.filter("false"), f"{tmp_path}/none") == {"product_ratings": 0, "time_analysis": 0, "review_length": 0}
    assert not glob.glob(f"{tmp_path}/none*")


def test_rows_without_a_json_form_are_skipped_and_told(spark, tmp_path):
    bad = "cast(unhex('C328') as string)"
    df = spark.sql(f"""
        select 1 id, 'é' t, array('a') n, map('k', 'v') m, named_struct('s', 'x') s, double('nan') d
        union all select 2, {bad}, array('a'), map('k', 'v'), named_struct('s', 'x'), 1
        union all select 3, null, array('a', {bad}), null, null, 2
        union all select 4, 't', null, map({bad}, 'v'), named_struct('s', {bad}), 3
        union all select 5, null, array(null), map('k', null), named_struct('s', null), null""")
    counts = sinks.write_json_or_reject(df, f"{tmp_path}/good", f"{tmp_path}/bad", None)
    assert counts == {"written": 2, "skipped": 3}
    lines = lambda name: [json.loads(x) for f in glob.glob(f"{tmp_path}/{name}/part-*") for x in open(f, encoding="utf-8")]
    good = sorted(lines("good"), key=lambda r: r["id"])
    assert good[0] == {"id": 1, "t": "é", "n": ["a"], "m": {"k": "v"}, "s": {"s": "x"}, "d": None} and good[1]["id"] == 5
    assert {r["row"]["id"]: r["error"] for r in lines("bad")} == {"2": "t", "3": "n", "4": "m, s"}
    whole = sinks.write_json_or_reject(df.filter("id = 1"), f"{tmp_path}/again", f"{tmp_path}/none", None)
    assert whole == {"written": 1, "skipped": 0} and not os.path.exists(f"{tmp_path}/none")


def test_a_file_that_cannot_be_read_fails_the_write(spark, tmp_path):
    with pytest.raises(PySparkException):
        folders.replace(spark.read.parquet(f"{tmp_path}/absent"), f"{tmp_path}/out", sinks.write_parquet)
