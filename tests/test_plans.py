"""Plans as they run: what is scanned, shuffled and joined."""

import re

import pytest
from compare import ROOT

from registry import REGISTRY

FOLDER = f"{ROOT}/sf0.001"


def plan(spark, name):
    df = REGISTRY[name].run(spark, FOLDER)
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_top_analysis_reads_the_reviews_once_and_limits_early(spark):
    text = plan(spark, "top_analysis")
    assert "lineitem" not in text, "all lists come from the written aggregates"
    assert re.search(r"WindowGroupLimit .* 10, Partial", text)
    text = plan(spark, "tagged_ratings")
    assert text.count("FileScan") == 2, "the reviews and their products, each once"


def test_top_k_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan(spark, "top_products_by_rating")


@pytest.mark.parametrize("name", ["product_ratings_avg", "monthly_trend", "length_buckets", "rating_histogram"])
def test_rating_jobs_neither_join_nor_read_more_than_needed(spark, name):
    text = plan(spark, name)
    assert "Join" not in text and text.count("FileScan") == 1
    columns = re.search(r"FileScan parquet \[([^\]]*)\]", text).group(1).split(",")
    assert len(columns) <= 3
    assert re.search(r"partial_(sum|count|avg)", text), "rows are combined before the shuffle"


@pytest.mark.parametrize("name", list(REGISTRY))
def test_no_cross_joins(spark, name):
    text = REGISTRY[name].run(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_no_query_forces_a_broadcast():
    import pathlib

    package = pathlib.Path(__file__).resolve().parent.parent / "reviewlens"
    for source in package.rglob("*.py"):
        text = source.read_text()
        assert "localCheckpoint" not in text, source
        # the llm operators broadcast tables whose size their parameters bound
        assert "broadcast(" not in text or "llm" in source.parts, source
