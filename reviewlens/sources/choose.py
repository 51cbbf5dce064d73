"""Take the first source of a list that can be read."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.errors import UNREADABLE, brief


def opens(df: DataFrame) -> None:
    """Touch every file of a source without reading its columns.

    Of Parquet files that is the end, where their layout is told, so one that was cut off or is no Parquet
    is met here. Text files are counted through: for them the probe costs a pass.
    """
    df.select(F.lit(1).alias("one")).agg(F.count("one")).collect()


def reads_whole(df: DataFrame) -> None:
    """Read every value of a source, which meets any fault there is, at the price of a pass."""
    df.write.format("noop").mode("overwrite").save()


def first_readable(
    candidates: Sequence[tuple[str, Callable[[], DataFrame]]],
    probe: Callable[[DataFrame], None] | None = opens,
) -> DataFrame:
    """Result of the first reader that works, with its name in column ``source``.

    Readers are tried in order, for instance the pairs table and then a saved
    report. ``probe`` looks for faults that only show while reading: by default
    it touches every file; ``reads_whole`` reads all of it; None leaves it out.
    Nothing is made up when all readers fail: the errors are raised.
    """
    errors = []
    for name, read in candidates:
        try:
            found = read()
            if probe is not None:
                probe(found)
            return found.withColumn("source", F.lit(name))
        except UNREADABLE as error:
            errors.append(f"{name}: {brief(error)}")
    raise ValueError("no readable source; " + "; ".join(errors))
