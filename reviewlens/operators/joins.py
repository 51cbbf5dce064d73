"""Joins that keep groups whose key is null."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def same_group_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null matches null; the keys come out once."""
    other = {key: f"_other_{key}" for key in keys}
    right = right.withColumnsRenamed(other)
    matches = [F.col(key).eqNullSafe(F.col(name)) for key, name in other.items()]
    return left.join(right, reduce(lambda a, b: a & b, matches), how).drop(*other.values())
