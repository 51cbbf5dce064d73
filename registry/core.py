from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Doubles at six decimals and dates as text, as both engines print them alike.

    Rounding at nine decimals first takes out what the order of summing leaves
    in the last digits, so that a mean ending in a 5 rounds up in every run.
    """

    def column(field):
        kind = field.dataType.typeName()
        if kind == "double":
            return F.round(F.round(field.name, 9), 6).alias(field.name)
        if kind == "date":
            return F.col(field.name).cast("string").alias(field.name)
        return F.col(field.name)

    return df.select(*[column(field) for field in df.schema.fields])


def query(name: str, sql: str | None = None):
    """Register a function of (spark, folder) under ``name`` with its SQL, if it has one."""

    def register(function):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return comparable(function(spark, folder))

        REGISTRY[name] = Query(run, sql)
        return function

    return register
