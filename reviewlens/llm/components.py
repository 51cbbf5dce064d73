"""Connected components by alternating large-star and small-star rounds.

Each round is two aggregations and one join over the edges and is written to the shared folder, so
lineage stays short and a lost executor repeats one round at most. No list of edges or nodes comes to
the driver: it sees one count and one checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.session import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("low"))
    return both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them. Edges lead from a to a smaller b."""
    low = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(low, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return low.select("a", F.col("low").alias("b")).unionByName(moved).distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s")).first()
    return row["n"], int(row["s"] or 0)


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, component) for every node that has an edge and is not the smallest of its component.

    ``edges`` has columns a and b; repeated edges, loops and nulls are harmless. No edges, no rows.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = written(edges, "edges")
    state = _state(edges)
    while state[0]:
        edges = written(_small_star(_large_star(edges)), "edges")
        last, state = state, _state(edges)
        if state == last:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
