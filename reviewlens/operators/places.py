"""Places in ordered lists of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.operators.joins import same_group_join
from reviewlens.session import written


def numbered(df: DataFrame, order: Sequence[Column], by: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """``df`` with the row's place, from 1, in its list: the rows equal in ``by``, along ``order``.

    One shuffle by ranges of (by, order) deals the lists out in stretches that follow one another, ties
    included as far as ``order`` tells rows apart, so a list of any size is spread over as many tasks as
    its data needs. The stretches are written, so that places are counted over the very rows that are
    returned. A row's place is its number within the stretch plus the sizes of its list's earlier
    stretches, of which there is one row per list and stretch. This part runs at once; the result is
    lazy. No rows give no rows; a null in ``by`` is a list of its own.
    """
    ordered = df.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)
    # Spark numbers rows as task << 33 | row
    rows = written(ordered.withColumn("_row", F.monotonically_increasing_id()), "places")
    rows = rows.withColumn("_stretch", F.shiftright("_row", 33))
    sizes = rows.groupBy(*by, "_stretch").agg(F.count("*").alias("_size"), F.min("_row").alias("_first"))
    earlier = F.sum("_size").over(Window.partitionBy(*by).orderBy("_stretch")) - F.col("_size")
    before = sizes.select(*by, "_stretch", (earlier - F.col("_first") + 1).alias("_shift"))
    placed = same_group_join(rows, before, [*by, "_stretch"])
    return placed.withColumn(name, F.col("_row") + F.col("_shift")).drop("_row", "_stretch", "_shift")
