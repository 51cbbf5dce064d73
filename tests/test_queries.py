"""Every registered query against its SQL. COMPARE_SF picks the scale (default sf0.001)."""

import os

import pytest
from compare import ROOT, difference, duck

from registry import REGISTRY

FOLDER = f"{ROOT}/{os.environ.get('COMPARE_SF', 'sf0.001')}"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, con, name):
    assert difference(spark, con, REGISTRY[name], FOLDER) is None


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == [
        "section_no", "section", "rank", "item_key", "avg_rating", "review_count",
    ]
    assert set(entry.oracle_sql()) <= set(entry.queries())
