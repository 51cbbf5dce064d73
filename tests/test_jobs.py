import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reviewlens.operators import mapreduce
from reviewlens.session import scratch_path, shared_folder, written

WORDS = "the quick brown the lazy dog the end".split()


def split_words(rows):
    words = rows["line"].str.split().explode().dropna()
    return words.to_frame("word").assign(n=1)


ADD = mapreduce.reduce_by(["word"], {"n": "sum"})


@pytest.mark.parametrize("salts", [None, 3])
@pytest.mark.parametrize("reducers", [None, 2])
def test_word_count(spark, salts, reducers):
    lines = spark.createDataFrame([(" ".join(WORDS),)] * 50, "line string").repartition(7)
    out = mapreduce.map_reduce(lines, split_words, ["word"], ADD, "word string, n bigint", reducers, salts)
    assert {r.word: r.n for r in out.collect()} == {w: 50 * c for w, c in Counter(WORDS).items()}


def test_hot_key_over_many_small_batches(spark):
    """Keys that run over batch ends are merged, whatever the batch size."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.range(0, 3000, 1, 9).select(
            F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 100 == 1, None)
            .otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("word")
        )
        out = mapreduce.map_reduce(
            df, lambda rows: rows.assign(n=1), ["word"], ADD, "word string, n bigint", salts=4
        )
        ours = {r.word: r.n for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert ours == {r.word: r["count"] for r in df.groupBy("word").count().collect()}


def test_piped_commands(spark):
    lines = spark.createDataFrame([(w,) for w in WORDS * 20], "line string").repartition(5)
    mapper = """awk '{print $1 "\\t1"}'"""
    reducer = """awk -F'\\t' 'NR > 1 && $1 != k {print k "\\t" n; n = 0} {k = $1; n += $2} END {if (NR) print k "\\t" n}'"""
    for combiner in (None, reducer):
        out = mapreduce.piped_map_reduce(lines, mapper, reducer, combiner, reducers=3)
        assert sorted(r.line for r in out.collect()) == sorted(f"{w}\t{20 * c}" for w, c in Counter(WORDS).items())


@pytest.mark.parametrize("line", ["a\tx\x01y", "\\N", "a\nb"])
def test_lines_that_a_pipe_would_change_are_refused(spark, line):
    lines = spark.createDataFrame([(line,), ("a\tb",)], "line string")
    with pytest.raises(Exception, match="U\\+0001"):
        mapreduce.piped_map_reduce(lines, "cat", "cat").collect()
    with pytest.raises(Exception, match="U\\+0001"):
        mapreduce.piped_map_reduce(lines.limit(0).union(spark.sql("select 'k'")), "printf 'a\\001b\\n'", "cat").collect()


def test_failing_command_fails_the_job(spark):
    with pytest.raises(Exception):
        mapreduce.piped_map_reduce(spark.range(5).selectExpr("string(id) line"), "cat; exit 3", "cat").collect()


def pairs(spark):
    return spark.range(1000).select(
        F.concat(F.lit("p"), F.col("id") % 20).alias("product_id"), (1 + F.col("id") % 5).cast("double").alias("rating")
    )


def test_intermediates_go_to_the_shared_folder(spark):
    folder = shared_folder(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or folder == configured
    assert spark.sparkContext.getCheckpointDir() is not None
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(folder)
    df = written(pairs(spark), "pairs")
    assert df.count() == 1000
    assert all(os.path.dirname(f).replace("file://", "").startswith(folder) for f in df.inputFiles())


WORD_ONE = """awk '{print $1 "\\t1"}'"""
SUM_UP = """awk -F'\\t' 'NR > 1 && $1 != k {print k "\\t" n; n = 0} {k = $1; n += $2} END {if (NR) print k "\\t" n}'"""


def hot_lines(spark):
    """A third of 12,000 lines on one key, the same line every time; a null and an empty line too."""
    word = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 400))
    return spark.range(0, 12000, 1, 6).select(word.alias("line")).union(spark.sql("select null union all select ''"))


def test_hot_keys_are_found_and_counted(spark):
    keyed = hot_lines(spark).filter("line <> ''").withColumnRenamed("line", "key")
    assert mapreduce.hot_keys(keyed, 1 / 8) == {"hot": 4000}
    assert mapreduce.hot_keys(keyed, 0.5) == {} == mapreduce.hot_keys(keyed.limit(0), 1 / 8)


def test_a_hot_key_without_a_combiner_is_split_or_refused(spark):
    lines = hot_lines(spark)
    plain = sorted(r.line for r in mapreduce.piped_map_reduce(lines, WORD_ONE, SUM_UP, reducers=8).collect())
    split = mapreduce.piped_map_reduce(lines, WORD_ONE, SUM_UP, reducers=8, hot="split")
    assert sorted(r.line for r in split.collect()) == plain and "hot\t4000" in plain
    with pytest.raises(mapreduce.HotKey, match="hot .4000 lines"):
        mapreduce.piped_map_reduce(lines, WORD_ONE, SUM_UP, reducers=8, hot="refuse")
    even = lines.filter("line <> 'hot'")
    assert mapreduce.piped_map_reduce(even, WORD_ONE, SUM_UP, reducers=8, hot="refuse").count() == 401
    with pytest.raises(ValueError):
        mapreduce.piped_map_reduce(lines, WORD_ONE, SUM_UP, hot="some")


def test_no_reducer_gets_twice_its_share(spark):
    """The reducer prints how many lines it read: one number per reducer of the first pass."""
    count = """awk -F'\\t' '{n += $2} END {if (NR) print "lines\\t" n}'"""
    lines = hot_lines(spark).filter("line <> ''")
    whole = [int(r.line.split("\t")[1]) for r in mapreduce.piped_map_reduce(lines, WORD_ONE, count, reducers=8).collect()]
    split = [
        int(r.line.split("\t")[1])
        for r in mapreduce.piped_map_reduce(lines, WORD_ONE, count, reducers=8, hot="split").collect()
    ]
    assert sum(whole) == sum(split) == 12000 and max(whole) > 4000 and max(split) <= 2 * 12000 / 8
