"""Text lengths and their ordered buckets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels in ascending order; each edge is the exclusive upper
# bound of its label, the last label is open.
LENGTH_LABELS = ("Very Short", "Short", "Medium", "Long", "Very Long")
LENGTH_EDGES = (100, 300, 600, 900)


def text_length(text: Column) -> Column:
    """Characters in ``text``; null counts as 0."""
    return F.coalesce(F.length(text), F.lit(0))


def first_positive_length(texts: Sequence[Column]) -> Column:
    """Length of the first non-empty text, 0 if there is none."""
    lengths = [F.nullif(F.length(text), F.lit(0)) for text in texts]
    return F.coalesce(*lengths, F.lit(0))


def length_bucket(
    length: Column,
    edges: Sequence[int] = LENGTH_EDGES,
    labels: Sequence[str] = LENGTH_LABELS,
) -> Column:
    if len(labels) != len(edges) + 1:
        raise ValueError("there must be one label more than edges")
    chain = reduce(
        lambda case, pair: case.when(length < pair[0], F.lit(pair[1])),
        zip(edges, labels),
        F.when(length.isNull(), F.lit(None).cast("string")),
    )
    return chain.otherwise(F.lit(labels[-1]))


def bucket_ordinal(label: Column, labels: Sequence[str] = LENGTH_LABELS) -> Column:
    """1-based position of a label in its order."""
    return F.array_position(F.array(*[F.lit(x) for x in labels]), label).cast("int")
