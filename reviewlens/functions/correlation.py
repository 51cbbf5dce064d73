"""Pearson correlation that survives a constant column, and its verbal band."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_corr(x: Column, y: Column) -> Column:
    """Aggregate: Pearson correlation over the pairs present, null if undefined."""
    both = x.isNotNull() & y.isNotNull()
    px, py = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    return F.try_divide(F.covar_pop(px, py), F.stddev_pop(px) * F.stddev_pop(py))


# Bands from the outside in. An edge belongs to its outer band.
BELOW = {"Strong Negative": -0.5, "Moderate Negative": -0.3}
ABOVE = {"Strong Positive": 0.5, "Moderate Positive": 0.3}
BETWEEN = "Weak/No Correlation"


def correlation_band(value: Column) -> Column:
    band = F.when(value.isNull(), "undefined")
    for label, edge in BELOW.items():
        band = band.when(value <= edge, label)
    for label, edge in ABOVE.items():
        band = band.when(value >= edge, label)
    return band.otherwise(BETWEEN)
