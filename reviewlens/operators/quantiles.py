"""Interpolated quantiles from counters: exact for any values by radix selection, or from a banded state."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from reviewlens.functions.order import rounded
from reviewlens.operators.joins import same_group_join
from reviewlens.session import written

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
#: Significant bits that each round has looked at when it ends.
ROUNDS = (7, 24, 40, 53)


def _wanted(counters: DataFrame, probabilities: Mapping[str, float], by: Sequence[str]) -> DataFrame:
    """The counters (cell, n, low, high) that hold the two values around each quantile: by, cell, low, high,
    n, name, end (0 the lower, 1 the upper), share of the way between them, index within the counter."""
    group = Window.partitionBy(*by)
    placed = counters.withColumn("_below", F.sum("n").over(group.orderBy("cell")) - F.col("n"))
    placed = placed.withColumn("_total", F.sum("n").over(group))
    ends = []
    for name, p in probabilities.items():
        at = F.lit(float(p)) * (F.col("_total") - 1)
        for end, index in enumerate((F.floor(at), F.ceil(at))):
            ends.append(
                F.struct(
                    F.lit(name).alias("name"),
                    F.lit(end).alias("end"),
                    (at - F.floor(at)).alias("share"),
                    (index - F.col("_below")).alias("index"),
                )
            )
    found = placed.select(*by, "cell", "low", "high", "n", F.inline(F.array(*ends)))
    return found.filter((F.col("index") >= 0) & (F.col("index") < F.col("n")))


def _interpolated(found: DataFrame, probabilities: Mapping[str, float], by: Sequence[str]) -> DataFrame:
    """One row per group from rows (name, end, share, value)."""

    def at(name: str, end: int, column: str):
        return F.max(F.when((F.col("name") == name) & (F.col("end") == end), F.col(column)))

    columns = []
    for name in probabilities:
        low, high = at(name, 0, "value"), at(name, 1, "value")
        between = low + (high - low) * at(name, 0, "share")
        columns.append(F.when(low == high, low).otherwise(between).alias(name))
    return found.groupBy(*by).agg(*columns)


def exact_quantiles(
    df: DataFrame,
    probabilities: Mapping[str, float] = QUARTILES,
    by: Sequence[str] = (),
    value: str = "rating",
    weight: str | None = None,
) -> DataFrame:
    """Interpolated quantiles per group of any number of distinct values, without ordering or gathering them.

    Radix selection over the bits of the doubles: a round counts, inside the map tasks and then across them,
    the rows by their values rounded to so many bits, and the counts tell which cells hold the wanted places;
    the next round looks at the rows of those cells only, with more bits. A cell with one value ends the
    search there, so a star scale takes one round, and no values more than four. Only counters are shuffled:
    64 between one power of two and the next in the first round, 2**17 per cell at most in the others. Each
    round reads ``df`` once more and runs at once; it is best a scan or a written table.

    Null and NaN values are left out, groups without values too. ``weight`` names a column with how often
    a row counts.
    """
    times = F.col(weight) if weight else F.lit(1)
    x = F.col(value).cast("double")
    rows = df.filter(x.isNotNull() & ~F.isnan(x)).select(
        *by, (x + F.lit(0.0)).alias("_value"), times.cast("bigint").alias("_times")
    )
    measures = [F.sum("_times").alias("n"), F.min("_value").alias("low"), F.max("_value").alias("high")]
    done, open_ = None, None
    for bits in ROUNDS:
        cell = rounded(F.col("_value"), bits).alias("cell")
        if open_ is None:
            hits = _wanted(rows.groupBy(*by, cell).agg(*measures), probabilities, by)
        else:
            keys = [*by, "_cell"]
            left = rows.withColumn("_cell", rounded(F.col("_value"), last))
            left = same_group_join(left, open_.select(*by, F.col("cell").alias("_cell")).distinct(), keys, "left_semi")
            hits = _narrowed(left.groupBy(*keys, cell).agg(*measures), open_, keys)
        still = Observation("open")  # counted by the job that writes
        hits = written(hits.observe(still, F.count_if(F.col("low") < F.col("high")).alias("n")), "quantiles")
        found = hits.filter("low = high").select(*by, "name", "end", "share", F.col("low").alias("value"))
        done = found if done is None else done.unionByName(found)
        open_, last = hits.filter("low < high"), bits
        if not still.get["n"]:
            break
    return _interpolated(done, probabilities, by)


def _narrowed(counters: DataFrame, open_: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The counters inside open cells that hold what is looked for there."""
    inside = Window.partitionBy(*keys).orderBy("cell")
    placed = counters.withColumn("_below", F.sum("n").over(inside) - F.col("n"))
    asked = open_.withColumnRenamed("cell", "_cell").drop("low", "high", "n")
    index = F.col("index") - F.col("_below")
    found = same_group_join(placed, asked, keys).withColumn("index", index)
    return found.filter((F.col("index") >= 0) & (F.col("index") < F.col("n"))).drop("_below", "_cell")


def banded_quantiles(
    bands: DataFrame,
    probabilities: Mapping[str, float] = QUARTILES,
    by: Sequence[str] = (),
    others: Sequence[Column] = (),
) -> DataFrame:
    """The same from a state with one row per band (``band``, ``count``, ``low``, ``high``), lazily.

    Exact where the bands that hold a quantile have one value each, as on every scale of up to three
    significant digits; elsewhere values are taken as evenly spread within their band, so a quantile is off
    by less than the band's width, one part in 8192 of the value. ``others`` are aggregates of the same
    groups that come along in the one pass over the state.
    """
    group = Window.partitionBy(*by)
    placed = bands.withColumn("_below", F.sum("count").over(group.orderBy("band")) - F.col("count"))
    placed = placed.withColumn("_total", F.sum("count").over(group))
    step = F.coalesce(F.try_divide(F.col("high") - F.col("low"), F.col("count") - 1), F.lit(0.0))
    held, columns = [], []
    for name, p in probabilities.items():
        at = F.lit(float(p)) * (F.col("_total") - 1)
        for end, index in (("low", F.floor(at)), ("high", F.ceil(at))):
            inside = index - F.col("_below")
            value = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.col("low") + step * inside)
            held.append(F.max(F.when((inside >= 0) & (inside < F.col("count")), value)).alias(f"_{name}_{end}"))
        low, high = F.col(f"_{name}_low"), F.col(f"_{name}_high")
        columns.append(F.when(low == high, low).otherwise(low + (high - low) * (at - F.floor(at))).alias(name))
    found = placed.groupBy(*by).agg(F.max("_total").alias("_total"), *held, *others)
    kept = [c for c in found.columns if c not in by and not c.startswith("_")]
    return found.select(*by, *columns, *kept)
